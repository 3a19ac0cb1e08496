"""Mixing, clustering and phrases against brute force, on edge cases and hot groups."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from shopsight.llm import centroids, mixing, phrases

ROWS = [
    (1, "a b  c\n", "x", 0), (2, None, "x", 0), (3, "", None, 0), (None, "one two", None, 0), (4, "w " * 9000, "y", 0), (4, "w " * 9000, "y", 0), (5, "w", "y", 0),
    (None, "one two", None, 0), (6, " \t", "empty", 0), (7, "a", "z", 0), (8, "b\x0bc\xa0d", "z", 0), (9, "q " * 40, "é", 0),
]
DOCS = "doc_id long, text string, source string, size int"


def brute_targets(sizes):
    """Targets by sharing what is over again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    free = set(names)
    while left > 1e-9 and free:
        unit = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += unit * weight[s]
        left = sum(max(0.0, target[s] - 3 * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


@pytest.mark.parametrize("rows_per_bucket", [2, 4_096])
def test_mixing_of_edge_cases(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows_per_bucket)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    docs = spark.createDataFrame(ROWS, DOCS).repartition(3)
    rows = mixing.taken(docs).collect()
    sizes = Counter()
    for _, text, source, _ in ROWS:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert sorted((r.doc_id or 0, r.source or "", r.size) for r in rows) == sorted(
        (i or 0, s or "", len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s, _ in ROWS
    )
    expected, got, longest = brute_targets(sizes), Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert r.taken == r.size * r.copies <= 3 * r.size
        got[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(got[s] - expected[s]) <= longest[s] / 2 for s in sizes)
    again = mixing.taken(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mixing.taken(docs.limit(0)).count() == 0


def test_positions_follow_the_schedules(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "w " * rng.randint(1, 9), f"s{i % 3}", 0) for i in range(3000)], DOCS)
    rows = mixing.mixed(mixing.assigned(docs)).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at and 0 <= r.position <= 1
        at += r.size
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    words = Counter()
    for r in rows:
        words[r.kind, r.position < 0.5] += r.size
    for kind, schedule in enumerate(mixing.SCHEDULES):
        early = mixing.integral([schedule[0], (0.5, (schedule[0][1] + schedule[-1][1]) / 2)]) / mixing.integral(schedule)
        share = words[kind, True] / (words[kind, True] + words[kind, False])
        assert abs(share - early) < 0.01
    with pytest.raises(ValueError):
        mixing.checked([(0.0, 1.0), (0.4, 1.0)])


def brute_clusters(rows, k, rounds, size):
    """cluster, distance of every kept row, and the centroids, with plain integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in order[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(means)) for _, v in kept]
        if turn < rounds:
            for j in range(len(means)):
                own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
                if own:
                    means[j] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, near)], means


def test_clusters_against_brute_force_with_edge_cases(spark):
    rng = random.Random(8)
    bad = [(1, None), (2, []), (3, [1.0, None, 0.0]), (4, [1.0, float("nan"), 0.0]), (5, [float("inf"), 0.0, 0.0]), (6, [1.0, 2.0]), (7, [0.0] * 4)]
    same = [(100 + i, [0.5, 0.25, -0.125]) for i in range(90)] + [(8, [0.1, 0.2, 0.3])] * 3 + [(None, [-0.001, 0.0, 0.001])] * 2
    rows = bad + same + [(1000 + i, [rng.choice([-1, 0, 1]) + rng.gauss(0, 0.1) for _ in range(3)]) for i in range(300)]
    table = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(4)
    for k in (1, 2, 12):
        expected, means = brute_clusters(rows, k, 5, 3)
        found, got = centroids.clustered(table, k, 5, 3)
        assert got.tolist() == means
        assert sorted(map(repr, found.collect())) == sorted(f"Row(vec_id={i}, cluster={c}, distance={d})" for i, c, d in expected)
    out = centroids.described(table, 12, 5, 3).collect()
    assert {r.inertia for r in out} == {sum(d for _, _, d in expected)}
    assert centroids.described(table.limit(0), 12, 5, 3).count() == 0
    assert {r.cluster for r in centroids.clustered(table.where("vec_id in (8)"), 12, 5, 3)[0].collect()} == {0}
    with pytest.raises(Exception, match="components are at most"):
        centroids.clustered(spark.createDataFrame([(1, [1e9, 0.0, 0.0])], "vec_id long, embedding array<double>"), 2, 1, 3)


def test_bounds_spare_most_comparisons_and_change_nothing():
    rng = np.random.default_rng(1)
    at = rng.integers(-4000, 4000, (20, 16))
    v = (at[rng.integers(0, 20, 3000)] + rng.integers(-200, 200, (3000, 16))).astype(np.int64)
    c, before = v[:20].copy(), None
    a = b = np.zeros(3000, np.int32)
    upper, lower, compared = np.full(3000, np.inf), np.zeros(3000), []
    for _ in range(8):
        search = centroids.Shallot(c, before)
        a, b, upper, lower, n = search.assign(v, a, b, upper, lower)
        compared.append(n)
        apart = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert (a == apart.argmin(axis=1)).all()
        exact = np.sqrt(apart.astype(float))
        assert (upper >= exact[np.arange(3000), a]).all()
        exact[np.arange(3000), a] = np.inf
        assert (lower <= exact.min(axis=1)).all()
        before, c = c, np.array([v[a == j].sum(axis=0) // max(1, (a == j).sum()) if (a == j).any() else c[j] for j in range(20)])
    assert compared[0] == 3000 and compared[-1] < 300


def brute_phrases(rows, least, limit):
    """The ranked phrases of (lang, text) rows by plain counting."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p in found:
            a = counts[p]
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            longer = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * counts[q] >= 80 * a for q in longer):
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("chunk,cells,shards", [(5, 64, 3), (400_000, 1 << 20, 4), (50, 1 << 12, 1)])
def test_phrases_against_plain_counts(spark, monkeypatch, chunk, cells, shards):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "CELLS", cells)
    rng = random.Random(3)
    words = ["a", "B", "cc", "été", "d-d", "x" * 300, "É"]
    rows = [(rng.choice(["en", "de a\nb", None, "und"]), "".join(rng.choice(words[: rng.randint(1, 7)]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "!,", "\x0b"]) for _ in range(rng.randint(0, 60)))) for _ in range(120)]
    rows += [("en", None), ("fr", ""), ("fr", " .\n"), ("es", "q " * 5000), ("pt", "only once here")] + [("en", "hot line of words")] * 40
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, k int").repartition(5)
    found = phrases.top_phrases(docs, 30, 7, shards).collect()
    assert sorted(map(tuple, found)) == brute_phrases(rows, 7, 30)


def test_phrases_whose_parts_share_cells_with_earlier_ones(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 300)
    monkeypatch.setattr(phrases, "CELLS", 1 << 10)
    rng = random.Random(5)
    common = [f"w{i}" for i in range(60)]
    rows = [("en", " ".join(rng.choices(common, k=40)) + f" . r{rng.randint(0, 150)} w1 w2 w3") for _ in range(700)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(16)
    found = phrases.top_phrases(docs, 5000, 4, 8).collect()
    assert sorted(map(tuple, found)) == brute_phrases(rows, 4, 5000)


def test_phrases_of_an_empty_table(spark):
    assert phrases.top_phrases(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_steps_are_never_later_than_noted(spark):
    tables = {}
    keys = [f"en{phrases.MARK}w{i} x" for i in range(3000)]
    for step in (0, 1, 2):
        phrases.noted(tables, spark.createDataFrame([(k,) for k in keys[step::3]], "key string"), step, 1 << 14)
    own = [[xxhash.xxh64_intdigest(f"en{phrases.MARK}{w}", phrases.SEED) for w in (f"w{i}", "x")] for i in range(3000)]
    hashes = phrases.mixed(np.array([h for h, _ in own], np.uint64), np.array([h for _, h in own], np.uint64))
    found = phrases.steps_of(tables[2], hashes)
    assert list(tables) == [2] and all((found[step::3] <= step).all() for step in (0, 1, 2)) and (found[2::3] == 2).mean() > 0.5
    assert (phrases.steps_of(tables[2], np.arange(1, 4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) == phrases.NEVER).mean() > 0.8


@pytest.mark.parametrize("words", [7, 1 << 20])
def test_phrases_are_counted_by_numbers_of_words(words):
    """The packed way and the one for numbers that pass 64 bits give the same phrases, first steps and counts."""
    rng = np.random.default_rng(3)
    ids = rng.integers(1, 7, 4_000).astype(np.int32)
    for k in (2, 3, 4):
        start = np.flatnonzero(rng.random(len(ids) - k) < 0.7)
        steps = ids[start].astype(np.int32) + ids[start + k - 1]
        own, begun, times = phrases._counted(ids, start, steps, k, words)
        assert begun.dtype == np.int32
        assert Counter(dict(zip(zip(*(n.tolist() for n in own), begun.tolist()), times.tolist()))) == Counter(
            (*(int(ids[s + j]) for j in range(k)), int(b)) for s, b in zip(start, steps)
        )


def test_phrases_number_words_of_odd_texts():
    texts = [b"", b"  A  b\t\tc ", b"\xff x. y", b"\x1c \x00 q,,q", b"a"]
    words, hashes, ids = phrases._encoded("en", texts)
    words = words.split(b" ")
    assert words == [b"\n", b"a", b"b", b"c", b"\xff", b"x", b"y", b"\x1c", b"\x00", b"q"]
    assert np.frombuffer(hashes, "<u8").tolist() == [xxhash.xxh64_intdigest(b"en\n" + w, phrases.SEED) for w in words]
    spelled = [words[i] for i in np.frombuffer(ids, "<i4")]
    assert spelled == [b"\n", b"a", b"b", b"c", b"\n", b"\xff", b"x", b"\n", b"y", b"\n", b"\x1c", b"\x00", b"q", b"\n", b"\n", b"q", b"\n", b"a", b"\n"]

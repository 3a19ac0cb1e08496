"""Document and page operators against brute force, on edge cases and planted groups."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shopsight.llm import exact_dedup, langid, licenses, near_dedup, quality_rules, queries, simhash, urls
from tests import oracle

EDGE = [
    (1, "same  text\n", "en", "k"), (2, " same text", "en", "k"), (3, "same text ", "en", "k"), (3, "same text ", "en", "k"), (4, None, None, None), (5, "", "en", "k"),
    (None, "same text ", "fr", "k"), (6, "\t \n", "fr", "k"), (7, "x" * 20000, "de", "k"), (None, None, None, None), (8, "w " * 20000, "de", "k"),
]
SCHEMA = "doc_id long, text string, lang string, fp string"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_copies_of_edge_cases(spark, parts):
    rows = exact_dedup.exact_copies(spark.createDataFrame(EDGE, SCHEMA).repartition(parts)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in EDGE:
        groups[hashlib.sha256(normal(text).encode()).hexdigest()].append(doc_id)
    assert len(rows) == len(EDGE)
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.exact_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dropping_exact_copies_keeps_columns_and_one_row(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA).withColumnRenamed("fp", "digest")
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert len({normal(r.text) for r in kept.collect()}) == kept.count() == len({normal(t) for _, t, *_ in EDGE})


def test_exact_copies_count_the_runs_that_were_written(spark, monkeypatch):
    """Eight splits are planned after twelve runs were written, as after a loss of executors."""
    docs = spark.createDataFrame([(i, "same") for i in range(12)], "doc_id long, text string").repartitionByRange(12, "doc_id")
    monkeypatch.setattr(exact_dedup, "input_partitions", lambda docs: 8, raising=False)
    rows = exact_dedup.exact_copies(docs).collect()
    assert sorted((r.doc_id, r.group_size, r.kept) for r in rows) == [(i, 12, i == 0) for i in range(12)]


def test_registered_oracles(spark, small):
    db = oracle.connect(small)
    for name, sql in queries.ORACLES.items():
        assert oracle.difference(queries.QUERIES[name](spark, small), db, sql) is None, name


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4:
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, doc_id in enumerate(ids):
        least[root(i)].append(doc_id)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(fps))]


def test_near_copies_against_all_pairs(spark, small):
    docs = queries.documents(spark, small).select("doc_id", "text", F.lit("x").alias("fp"), F.lit(1).alias("key"))
    given = docs.collect()
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_copies(docs).collect()}
    fps = [brute_fingerprint(r.text) for r in given]
    expected = brute_components(fps, [r.doc_id for r in given])
    assert found == {r.doc_id: (fp, c) for r, fp, c in zip(given, fps, expected, strict=True)}


def test_golay_keys_find_all_pairs_within_four_bits():
    rng = np.random.default_rng(7)
    fps = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for bits in range(5):
        masks = np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in fps], dtype=np.uint64)
        stored, looked = simhash.keys_of(fps)[0], simhash.keys_of(fps ^ masks)[1]
        met = set(zip(*(x.tolist() for x in stored))) & set(zip(*(x.tolist() for x in looked)))
        assert {row for row, _ in met} == set(range(len(fps)))


def test_links_of_a_dense_group_join_it_without_all_pairs(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        fps.add(rng.choice(sorted(fps)) ^ sum(1 << b for b in rng.sample(range(12), 2)))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)).collect()
    assert len(edges) < 40 * len(fps)
    parent = {x: x for x in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        assert ((e.u ^ e.v) & (2**64 - 1)).bit_count() <= 4
        parent[root(e.u)] = root(e.v)
    found = defaultdict(set)
    for x in signed:
        found[root(x)].add(x)
    expected = defaultdict(set)
    for x, c in zip(signed, brute_components([x & (2**64 - 1) for x in signed], signed), strict=True):
        expected[c].add(x)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_near_copies_of_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    rows = simhash.near_copies(docs).collect()
    assert len(rows) == len(EDGE)
    assert {r.fingerprint for r in rows if r.doc_id in (4, 5, 6)} == {"0" * 16}
    assert {r.component_id for r in rows if r.doc_id in (4, 5, 6)} == {4}
    assert simhash.near_copies(docs.limit(0)).count() == 0


def five_words(text):
    words = (text or "").lower().split()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_similar(texts, ids):
    """component_id of every row by all pairs of sets."""
    sets, parent = [five_words(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, doc_id in enumerate(ids):
        least[root(i)].append(doc_id)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(texts))]


def test_pipeline_drops_all_copies_of_similarity_four_fifths(spark, small):
    docs = queries.documents(spark, small)
    given = docs.select("doc_id", "text").collect()
    expected = brute_similar([r.text for r in given], [r.doc_id for r in given])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, small).collect()}
    assert kept == {r.doc_id for r, c in zip(given, expected, strict=True) if r.doc_id == c}
    assert {177, 145}.isdisjoint(kept)  # similarity 0.83 to 1 and to 6


def test_near_copies_of_one_text_write_rows_in_proportion(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(9999)}" for _ in range(100)]
    texts = []
    for _ in range(1200):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):  # most pairs are less similar than 0.8, also of texts that share a key
            words[rng.randrange(100)] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(words))
    written = []

    def counted(df, name, write=near_dedup.stored):
        out = write(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dedup, "stored", counted)
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in near_dedup.components(docs).collect()}
    assert [found[i] for i in range(1200)] == brute_similar(texts, range(1200))
    assert max(n for _, n in written) <= 1200 * near_dedup.BANDS


def test_unlinked_sets_of_one_key_leave_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 256)
    rng = np.random.default_rng(4)
    core = rng.integers(0, 2**62, 100)
    sets = [np.unique(np.concatenate([core, rng.integers(0, 2**62, 60)])) for _ in range(2000)]
    sets[7] = np.unique(np.concatenate([sets[1500][:150], [5]]))
    made = spark.createDataFrame([(i, s.astype("<u8").tobytes()) for i, s in enumerate(sets)], "node long, hashes binary")
    apart = made.select(F.explode(F.expr("array(1L, 2L)")).alias("key"), "node", F.lit(160).cast("long").alias("n"), F.col("node").alias("root"))
    assert [(r.u, r.v) for r in near_dedup._compared(apart, made, 0.8).collect()] in ([(7, 1500)], [(1500, 7)])


def test_similar_texts_of_mixed_groups_and_edge_cases(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(9999)}" for _ in range(200)] for _ in range(4)]
    rows = [(1000 + i, text, "en", "s", 0) for i, text in enumerate([" ".join(w) for w in base])]
    for i in range(120):
        words = list(base[i % 4])
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(200)] = f"x{rng.randrange(9999)}"
        rows.append((i, " ".join(words), "en", "s", 0))
    given = [(r[0], r[1]) for r in rows] + [(2000, None), (2001, " "), (2002, ""), (2003, "a B"), (2004, "A  b"), (None, "a b"), (None, "alone here")]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    expected = brute_similar([t for _, t in given], [i for i, _ in given])
    kept = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in near_dedup.drop_near_copies(docs).collect())
    assert kept == sorted((i if i is not None else -1, t or "") for (i, t), c in zip(given, expected, strict=True) if i == c)
    assert near_dedup.drop_near_copies(docs.limit(0)).count() == 0


def test_language_is_right_on_held_out_documents(spark, small):
    docs = queries.documents(spark, small)
    rows = queries.language_query(spark, small).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_edge_cases_and_block_scores(spark):
    rng = random.Random(9)
    train = [(i, " ".join(rng.choices(["the cat", "and dogs"] if i % 2 else ["le chat", "des chiens"], k=30)), "en" if i % 2 else "fr") for i in range(200)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["en", "fr"]
    rows = langid.predicted(spark.createDataFrame(EDGE, SCHEMA), model, ("doc_id", "lang")).collect()
    assert len(rows) == len(EDGE)
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6)} == {"und"}
    assert model.predict(["12 345 !!", None, "the cat", "le chat"])[0] == ["und", "und", "en", "fr"]
    assert langid.fit(docs.where("lang is null")).predict(["the"]) == (["und"], [0.0])


def brute_kernel(a, b):
    sets = [[{t.encode()[i : i + n] for i in range(len(t.encode()) - n + 1)} for n in (1, 2)] for t in (a, b)]
    return [len(x & y) for x, y in zip(*sets)]


def test_language_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    rows = [(3, "the same words of a text", "en")] * 300 + [(3, f"ein anderer Text {i}", "de") for i in range(300)] + [(i, f"le texte numero {i}", "fr") for i in range(400)]
    sizes = []
    solve = langid._solve
    monkeypatch.setattr(langid, "_solve", lambda sample, *rest: sizes.append(Counter(r.lang for r in sample)) or solve(sample, *rest))
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6), sample_rows=90)
    assert sizes == [{"en": 1, "de": 30, "fr": 30}] and model.languages == ["de", "en", "fr"]
    with pytest.raises(ValueError, match="languages"):
        langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=2)


def test_presence_counts_common_short_grams():
    a, b = langid.presence(["banana band", "bandana"]).astype(int)
    assert (a[:256] & b[:256]).sum() == brute_kernel("banana band", "bandana")[0]
    pairs = slice(256, 256 + langid.PAIR_COLUMNS)
    assert (a[pairs] & b[pairs]).sum() == brute_kernel("banana band", "bandana")[1]


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_and_verdicts(spark, small):
    extra = [(-1 - i, t, "en", "s", 0) for i, (_, t, *_) in enumerate(EDGE)]
    extra += [(-50, "a b c d e " * 3, "en", "s", 0), (-51, "a b c d e f a b c d e", "en", "s", 0), (-52, "x\nx\n \nx\n é😀", "en", "s", 0), (-53, "a a a a a a", "en", "s", 0)]
    docs = queries.documents(spark, small)
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality_rules.judged(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[m] for m in quality_rules.MEASURES) == brute_measures(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    kept = quality_rules.kept_documents(docs.withColumn("n_words", F.lit("clash")))
    assert kept.columns == [*docs.columns, "n_words"]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    assert quality_rules.judged(docs.limit(0)).count() == 0


def test_verdicts_agree_with_labels_that_they_never_saw(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules.judged(queries.documents(spark, sf)).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / max(1, len(bad)) < 0.15


def test_posteriors_are_those_of_a_plain_em(spark):
    rng = random.Random(10)
    votes = [tuple(rng.choice([-1, 0, 1, 1]) for _ in quality_rules.VOTES) for _ in range(60)]
    names = [f"v_{n}" for n in quality_rules.VOTES]
    frame = spark.createDataFrame(votes, ", ".join(f"{n} byte" for n in names))
    found = {tuple(r[n] for n in names): r.posterior for r in quality_rules.vote_model(frame, rounds=7).collect()}
    n = len(names)
    good, bad, share = [quality_rules.START_FALSE_ALARM] * n, [quality_rules.START_ALARM] * n, quality_rules.START_SHARE

    def posterior(v):
        odds = math.log(share / (1 - share))
        for x, g, b in zip(v, good, bad):
            odds += math.log(g / b) if x < 0 else math.log((1 - g) / (1 - b)) if x > 0 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(7):
        p = [posterior(v) for v in votes]
        new = []
        for weights in (p, [1 - x for x in p]):
            alarms = [sum(w for w, v in zip(weights, votes) if v[r] < 0) for r in range(n)]
            calm = [sum(w for w, v in zip(weights, votes) if v[r] > 0) for r in range(n)]
            new.append([(a + 1) / (a + c + 2) for a, c in zip(alarms, calm)])
        good, bad = new
        share = (sum(p) + 1) / (len(p) + 2)
    for v in votes:
        assert found[v] == pytest.approx(posterior(v), rel=1e-6)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "ftp://a.www.Example.com/en/", "http://example.com",
    "http://example.com/EN/", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://net.org/fr/", "a://b://example.com/en/",
    "http://example.com?/en/", "http://example.com#/en/", "http://.com/", "http://com/", "x" * 5000 + "://example.com/en/" + "y" * 5000, "http://é.net/es/\n",
]


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("rules", [queries.URL_RULES, [], [("example.com", "/", "block"), ("com", "/en/", "block"), ("com", "", "allow"), ("", "", "block")]])
def test_urls_against_brute_force(spark, rules):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h")], "page_id long, url string, rule string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    rules = [r for r in rules if r[0]]
    rows = urls.judged(pages, listed).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(URLS[r.page_id], rules), URLS[r.page_id]


def test_filter_has_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(11)
    keys, others = rng.integers(-(2**63), 2**63, (2, 20000))
    made = urls.BlockedFilter(20000 * urls.BITS_PER_KEY // 512 + 1)
    made.add(keys)
    assert made.may_hold(keys).all()
    assert made.may_hold(others).mean() < 0.02


FILES = [
    ("LICENSE", "Released under the MIT License."), ("a.py", "x = 1"), ("src/b.py", "y"), ("src/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
    ("src/deep/c.py", None), ("src/deep/d.py", "z\nLicensed under the Apache License, Version 2.0.\nq"), ("srcx/e.py", ""), (None, "Licensed under CC BY-NC 4.0."), ("odd/LICENSE", "my own words"),
    ("odd/f.py", "no license here, sorry, please ask the author of the file about its use"),
]


def test_licenses_and_inheritance(spark):
    files = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(FILES)], "row long, path string, text string, word string")
    rows = {r.path: (r.license, r.license_from) for r in licenses.licensed(files).collect()}
    assert rows == {
        "LICENSE": ("MIT", "own"), "a.py": ("MIT", ""), "src/b.py": ("GPL-3.0", "src"), "src/LICENSE.txt": ("GPL-3.0", "own"), "src/deep/c.py": ("GPL-3.0", "src"),
        "src/deep/d.py": ("Apache-2.0", "own"), "srcx/e.py": ("MIT", ""), None: ("CC-BY-NC-4.0", "own"), "odd/LICENSE": ("MIT", ""), "odd/f.py": ("MIT", ""),
    }
    assert licenses.licensed(files.limit(0)).count() == 0


MIT_FILE = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_FILE = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
APACHE_FILE = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document.
"""


def test_whole_license_files_give_their_license(spark, tmp_path):
    for text, name in ((MIT_FILE, "MIT"), (BSD_FILE, "BSD-3-Clause"), (APACHE_FILE, "Apache-2.0")):
        folder = tmp_path / name
        rows = [(300, text, "code"), (301, "no words of it here", "code"), (400, "my own words", "code"), (401, "none", "code")]
        spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
        found = {r.doc_id: (r.license, r.license_from) for r in queries.license_query(spark, str(folder)).collect()}
        assert found == {300: (name, "own"), 301: (name, "code/3"), 400: (None, None), 401: (None, None)}


HEADERS = [
    ("# This work is licensed under a Creative Commons Attribution-\n# NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("# This work is licensed under the\nimport os", None),
    ("# This work is licensed under the\n# Mozilla Public License, v. 2.0.", "MPL-2.0"),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not\n * distributed */", "MPL-2.0"),
    ("// SPDX-License-Identifier: ISC", None), ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
    *((f"# SPDX-License-Identifier: {name}", name) for name in licenses.TEMPLATES if name != "Proprietary"),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), ("# SPDX-License-Identifier: LicenseRef-Proprietary", "Proprietary"),
]


def test_wrapped_headers_and_identifiers(spark):
    files = spark.createDataFrame([(i, f"{i}.py", text) for i, (text, _) in enumerate(HEADERS)], "row long, path string, text string")
    found = {r.row: r.license for r in licenses.licensed(files).collect()}
    assert found == {i: name for i, (_, name) in enumerate(HEADERS)}


def brute_license(path, text):
    weights, idf, norms = defaultdict(dict), {}, {}
    for name, word, weight, w_idf in licenses.template_weights(licenses.TEMPLATES):
        weights[name][word], idf[word] = weight, w_idf
    top = math.log(1 + len(weights)) + 1
    sections = [text or ""] if path and re.search(licenses.LICENSE_FILE, path) else [s for s in (text or "").split("\n") if re.search(licenses.NAMES_LICENSE, s)]
    best = []
    for section in sections:
        x = {w: n * idf.get(w, top) for w, n in Counter(re.findall(licenses.WORD, section.lower())).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        best += [(-round(sum(x.get(w, 0) * v for w, v in own.items()) / norm, 9), name) for name, own in weights.items() if norm]
    score, name = min(best, default=(0, ""))
    return (name.split("#")[0], -score) if -score >= licenses.MIN_SCORE else (None, None)


def test_license_scores_against_brute_force(spark, small):
    rows = queries.license_query(spark, small).collect()
    texts = {r.doc_id: r.text for r in queries.documents(spark, small).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        name, score = brute_license(r.path, texts[r.doc_id])
        if r.license_from == "own":
            assert (r.license, r.score) == (name, pytest.approx(score, abs=1e-6))
        else:
            assert name is None

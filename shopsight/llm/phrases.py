"""Phrase mining by dynamic itemset counting.

Documents are cut into words once and written as chunks of numbered words in `SHARDS` shards, which are scanned in a cycle. Single words are counted from the first
shard on. A longer phrase becomes active once both of its parts (without the last word, without the first) have been
met `min_count` times in what was scanned so far; it is counted from the next shard on, until it has seen every
shard once. So lengths are interleaved: most pairs are counted while words still are, and no phrase is counted whose parts
are rare. A phrase with `min_count` occurrences has parts with as many, so none is missed, and whoever is active
sees the whole corpus, so counts are exact.

When a part becomes frequent, its step is noted in two cells of a table of `CELLS` bytes a length, unless they already hold
an earlier one. The later of its two cells is the step from which a task takes a part as frequent. It is never later than
the true one, stays the same once it is set, and every task reads it from the same table. A part counts as frequent no
earlier than in the step from which it is counted itself, whatever its cells hold; so each phrase has one first
step and is counted through exactly one cycle. Parts that share cells only let more phrases be counted; a table
that has filled up costs time, not exactness. The tables are all that is broadcast.

Results: candidates are the phrases of 2 to `LONGEST` words; see `scored` and `top_phrases`.

Everything is per language; null is `und`, as is a language of that name. Text is lower-cased (A-Z), cut into pieces at
`.,;:!?` and line ends, and into words at spaces and tabs; null is empty. Repeated rows count each. An empty table
gives an empty result; further columns, whatever their names, are ignored. A task holds `WAITING_WORDS` words and one text
when it writes, and `CHUNKS_AT_ONCE` chunks of `CHUNK_WORDS` words (or one text) when it scans.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shopsight.llm.common import batch_rows, bounded_batches, removed, stored, text_column
from shopsight.session import scratch_uri

MIN_COUNT = 30
LONGEST = 4
SHARDS = 4
CHUNK_WORDS = 400_000
WAITING_WORDS = 10 * CHUNK_WORDS  # of all languages together
CHUNKS_AT_ONCE = 4
ROW_GROUP_BYTES = 32 << 20
CODED = ["lang", "words", "hashes", "ids"]
CELLS = 1 << 22
NEVER = 255
MARK = "\n"  # no phrase has one, so the last one in a key ends the language
SEED = 42
SALTS = 32
BREAK = b"\n"
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\v\f\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
KEY = ["lang", "k", "phrase"]


def mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its start and its last word."""
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def places(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each phrase."""
    n = np.uint64(cells)
    return (hashes % n).astype(np.int64), ((hashes >> np.uint64(29)) % n).astype(np.int64)


def steps_of(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The step from which each phrase is taken as frequent, `NEVER` if it is not."""
    first, second = places(hashes, len(table))
    return np.maximum(table[first], table[second])


def noted(tables: dict[int, np.ndarray], reached: DataFrame, step: int, cells: int) -> set[int]:
    """Note in the tables which phrases (column key) became frequent, and return their lengths; at most a row for 64 cells reaches the driver."""
    from xxhash import xxh64_intdigest

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ks, hashes = [], []
            for key in part.column("key").to_pylist():
                lang, words = key.rsplit(MARK, 1)
                own = [xxh64_intdigest(f"{lang}{MARK}{w}", SEED) for w in words.split(" ")]
                h = np.array([own[0]], np.uint64)
                for w in own[1:]:
                    h = mixed(h, np.array([w], np.uint64))
                ks.append(len(own))
                hashes.append(h[0])
            two = np.concatenate(places(np.array(hashes, np.uint64), cells))
            yield pa.RecordBatch.from_arrays([pa.array(ks * 2, pa.int32()), pa.array(two)], names=["k", "cell"])

    found = reached.select("key").mapInArrow(work, "k int, cell long")
    words = found.groupBy("k", F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")).toArrow()
    lengths = set(words.column("k").to_pylist())
    for k in lengths:
        own = words.filter(pa.compute.equal(words.column("k"), k))
        bits = np.unpackbits(own.column("bits").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cell = (own.column("word").to_numpy()[:, None] * 64 + np.arange(64))[bits.astype(bool)]
        table = tables.setdefault(k, np.full(cells, NEVER, np.uint8))
        table[cell] = np.minimum(table[cell], step)
    return lengths


def _encoded(lang: str, texts: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """The different words of some texts, their hashes, and the texts as numbers of words with a break after each piece.

    Words have numbers in the order in which they come first; 0 is the break between pieces.
    """
    from xxhash import xxh64_intdigest

    text = BREAK + b" " + BREAK.join(texts).translate(FOLDED).replace(BREAK, b" \n ")
    coded = pa.compute.split_pattern(pa.array([text], pa.large_binary()), b" ").flatten().dictionary_encode()
    known, ids = coded.dictionary.to_pylist(), coded.indices.to_numpy()[1:]
    if b"" in known:  # between spaces in a row
        empty = known.index(b"")
        del known[empty]
        ids = ids[ids != empty]
        ids = ids - (ids > empty)
    mark = (lang + MARK).encode()
    hashes = np.array([xxh64_intdigest(mark + w, SEED) for w in known], "<u8")
    return b" ".join(known), hashes.tobytes(), np.append(ids, 0).astype("<i4").tobytes()


def _codes(ids: np.ndarray, start: np.ndarray, k: int, words: int) -> np.ndarray:
    """A number for each phrase of `k` words, equal for equal phrases only."""
    code = ids[start].astype(np.int64)
    for j in range(1, k):
        if len(code) and int(code.max()) >= (1 << 62) // words:
            code = np.unique(code, return_inverse=True)[1]
        code = code * words + ids[start + j]
    return code


def _counted(ids: np.ndarray, start: np.ndarray, begun: np.ndarray, k: int, words: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(numbers of the words at each place, first steps, counts) of the different phrases of `k` words; equal phrases have equal first steps."""
    if words**k >= 1 << 55:
        _, first, times = np.unique(_codes(ids, start, k, words), return_index=True, return_counts=True)
        return [ids[start[first] + j] for j in range(k)], begun[first], times
    # phrase and first step in one number: sorted without places, and taken apart again
    codes = np.sort(_codes(ids, start, k, words) << 8 | begun)
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    times, codes = np.diff(np.append(first, len(codes))), codes[first]
    begun, codes, own = (codes & 255).astype(np.int32), codes >> 8, []
    for _ in range(k - 1):
        rest = codes // words
        own.append(codes - rest * words)
        codes = rest
    return [codes, *reversed(own)], begun, times


def _chunk(lang: str, words: bytes, own: np.ndarray, ids: np.ndarray, tables: dict[int, np.ndarray], step: int, shards: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(keys, first steps, counts) of the active phrases of each length, from texts as `_encoded` gives them."""
    spelled = pa.array(words.decode("utf-8", "replace").split(" "), pa.string())
    leading = pa.compute.binary_join_element_wise(pa.scalar(f"{lang}{MARK}"), spelled, "")
    if step < shards:
        yield leading[1:], np.zeros(len(own) - 1, np.int32), np.bincount(ids, minlength=len(own))[1:]
    if 1 not in tables:
        return
    since = steps_of(tables[1], own).astype(np.int32)
    since[0] = NEVER
    at = np.flatnonzero(since[ids] < step)  # places where a frequent phrase of k-1 words starts
    since, hashes = since[ids[at]], own[ids[at]]
    for k in range(2, LONGEST + 1):
        # the last k-1 words of a phrase start one place after its first ones
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        start, begun = at[both], np.maximum(since[both], since[both + 1]) + 1
        active = begun + shards > step
        if active.any():
            (lead, *rest), first_steps, times = _counted(ids, start[active], begun[active], k, len(own))
            yield pa.compute.binary_join_element_wise(leading.take(pa.array(lead)), *(spelled.take(pa.array(n)) for n in rest), " "), first_steps, times
        if k == LONGEST or k not in tables:
            return
        hashes = mixed(hashes[both], own[ids[start + k - 1]])
        # cells of other phrases may be earlier than a phrase is counted
        since = np.maximum(steps_of(tables[k], hashes).astype(np.int32), begun)
        ok = since < step
        at, since, hashes = start[ok], since[ok], hashes[ok]


def _scan(shard: DataFrame, tables: dict[int, np.ndarray], step: int, shards: int) -> DataFrame:
    """key (language and phrase), c and begun of the phrases that are active in this step, as each task's chunks count them."""
    # mostly empty tables take little room in every executor's folder
    shared = shard.sparkSession.sparkContext.broadcast({k: zlib.compress(t.tobytes(), 1) for k, t in tables.items()})

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: np.frombuffer(zlib.decompress(t), np.uint8) for k, t in shared.value.items()}
        for part in parts:
            for lang, words, own, ids in zip(*(part.column(name) for name in CODED)):
                numbers = np.frombuffer(own.as_buffer(), "<u8"), np.frombuffer(ids.as_buffer(), "<i4")
                for key, begun, times in _chunk(lang.as_py(), words.as_py(), *numbers, known, step, shards):
                    yield pa.RecordBatch.from_arrays([key, pa.array(times.astype(np.int64)), pa.array(begun, pa.int32())], names=["key", "c", "begun"])

    return shard.select(*CODED).mapInArrow(work, "key string, c long, begun int")


def _sharded(docs: DataFrame, shards: int) -> DataFrame:
    """The texts as chunks of numbered words (lang and what `_encoded` gives), dealt into shards in turn and written by shard.

    So texts are cut into words once, and a scan of one shard reads no other.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = count(TaskContext.get().partitionId())
        waiting: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        held = 0

        def chunk(lang: str) -> pa.RecordBatch:
            nonlocal held
            held -= size.pop(lang)
            made = lang, *_encoded(lang, waiting.pop(lang)), next(turns) % shards
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, (pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))], names=[*CODED, "shard"])

        for part in parts:
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                waiting.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                held += len(text) + 1
                if size[lang] > 6 * CHUNK_WORDS:
                    yield chunk(lang)
                elif held > 6 * WAITING_WORDS:
                    yield chunk(max(size, key=size.get))
        for lang in list(waiting):
            yield chunk(lang)

    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_column().cast("binary").alias("text"))
    coded = "lang string, words binary, hashes binary, ids binary, shard int"
    uri = scratch_uri(spark, "phrase-shards")
    rows.mapInArrow(work, coded).write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("shard").parquet(uri)
    return spark.read.schema(coded).parquet(uri)


def counted_phrases(docs: DataFrame, min_count: int = MIN_COUNT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of every phrase of up to `LONGEST` words with f >= min_count, and (lang, n)."""
    spark = docs.sparkSession
    dealt = _sharded(docs, shards)
    state = stored(spark.createDataFrame([], "key string, c long, begun int, reached int"), "phrase-counts")
    phrase = F.substring_index("key", MARK, -1)
    lang = F.substring(F.col("key"), F.lit(1), F.length("key") - F.length(phrase) - 1).alias("lang")
    single = F.instr(phrase, " ") == 0
    tables: dict[int, np.ndarray] = {}
    last: dict[int, int] = {}  # the last step in which a phrase of each length became frequent
    total, step = None, 0
    while step < shards or any(step <= last[k] + shards for k in last if k < LONGEST):
        new = _scan(dealt.where(F.col("shard") == step % shards), tables, step, shards)
        every = state.unionByName(new.withColumn("reached", F.lit(None).cast("int")))
        sums = every.groupBy("key").agg(F.sum("c").alias("c"), F.max("begun").alias("begun"), F.max("reached").alias("reached"))
        sums = sums.withColumn("reached", F.coalesce("reached", F.when(F.col("c") >= min_count, step)))
        # who has seen every shard and is still rare is done; words stay one step more, as their total is needed
        waits = F.lit(step + 1) < F.col("begun") + F.when(single, shards + 1).otherwise(shards)
        with batch_rows(spark, CHUNKS_AT_ONCE):
            after = stored(sums.where(F.col("reached").isNotNull() | waits), "phrase-counts")
        removed(state)
        state = after
        last |= dict.fromkeys(noted(tables, state.where(F.col("reached") == step), step, CELLS), step)
        step += 1
        if step == shards:
            total = stored(state.where(single).groupBy(lang).agg(F.sum("c").alias("n")), "phrase-words")
    removed(dealt)
    found = state.where("reached is not null").select(lang, phrase.alias("phrase"), F.col("c").alias("f"))
    return found.select("lang", F.size(F.split("phrase", " ")).alias("k"), "phrase", "f"), total


def scored(frequent: DataFrame, occurrences: DataFrame) -> DataFrame:
    """lang, k, phrase, a, l, r, n and score of every candidate that stays.

    A candidate is cut after its first words; the cut with the lowest floor(2000000 a / (l + r)) counts, of equal ones the
    first. A candidate goes if a longer one that contains its words has at least four fifths of its occurrences.
    """
    words = F.split("phrase", " ")
    candidates = frequent.where("k > 1")
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.withColumn("lead", F.expr("substring_index(phrase, ' ', cut)")).withColumn("tail", F.expr("substring(phrase, length(lead) + 2)"))
    for name, count in (("lead", "l"), ("tail", "r")):
        own = frequent.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(count))
        cut = cut.join(own, (F.col("lang") == F.col("_lang")) & (F.col(name) == F.col("_phrase"))).drop("_lang", "_phrase")
    whole = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"(cast(2000000 as decimal(7,0)) * {whole('f')}) div ({whole('l')} + {whole('r')})")
    lowest = cut.withColumn("score", score).groupBy(*KEY).agg(F.first("f").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    inside = candidates.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.coalesce(F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(19,0)") >= F.lit(80).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)"), F.lit(False))
    rows = lowest.join(inside, ["lang", "phrase"], "left").where(~covered).join(occurrences, "lang")
    return rows.select(*KEY, "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def top_phrases(docs: DataFrame, limit: int = 2000, min_count: int = MIN_COUNT, shards: int = SHARDS) -> DataFrame:
    """Each language's first `limit` candidates: lang, rank, phrase, a, l, r, n, score.

    They are ranked within `SALTS` parts of a language first, so no task ranks more than `limit` rows a part.
    """
    rows = scored(*counted_phrases(docs, min_count, shards)).drop("k")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= limit)
    best = parts.drop("salt", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= limit)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

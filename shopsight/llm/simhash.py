"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint of a text: lower-case A-Z, take words between ASCII white space and all shingles of `SHINGLE` words;
a bit is 1 where over half of the shingles' XXH64 values have it. Fingerprints link at `MAX_BITS` or fewer
differing bits; documents of linked fingerprints form a component.

Search. 64 bits fall into three segments (22, 21, 21 bits), each read as a word of the perfect binary Golay code
[23, 12, 7]. Four errors in three segments leave one of two cases:

- two segments with at most one error each. A word has its nearest codeword (at most 3 bits away), and a word one
  bit off is at most 4 bits from it. So each fingerprint is stored once for a pair of segments, under the two
  nearest codeword indices, and looked up under every pair of codeword indices within 4 bits (one such
  codeword for 13.5 % of the words, six for the others);
- one segment without error and the other two with exactly two errors each: the exact segment and the parities of
  the other two are equal.

Both cases are joins of different fingerprints on equal keys: rows are dealt and sorted by key, and every
candidate is verified by its Hamming distance. Equal texts and equal fingerprints meet once, however many documents
have them. Many different fingerprints close to each other (near copies of one text) are compared, but only a
spanning forest of their links leaves the task: see `bucket_links`.

Null and blank texts have no word and fingerprint zero, which links like any other. Texts are read whole. Rows that repeat
are kept. Null identifiers rank last as component name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopsight.llm.common import batch_rows, batches, stored, text_column
from shopsight.operators.graphs import connected_components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
CUTS = ((0, 22), (22, 21), (43, 21))  # first bit and width of each segment
GENERATOR = 0b101011100011  # fixed value: x^11+x^9+x^7+x^6+x^5+x+1 of the Golay code
COUNT_ROWS = 1 << 15
LINK_ROWS = 1 << 16
KEYED_ROWS = 1 << 12


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text; memory is bounded by the text itself."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for k in range(0, n, COUNT_ROWS):
        last = min(n, k + COUNT_ROWS)
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k:last].tolist(), ends[k + size - 1 : last + size - 1].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def work(part: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, size) for t in part.column("text").to_pylist()], "<u8").view("<i8")
        return {"doc_id": part.column("doc_id"), "fp": fps}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().cast("binary").alias("text"))
    return batches(texts, work, "doc_id long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(bit) & 1, rest ^ np.uint32(GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error to the nearest codeword; errors of weight 4 (five or none) and how many."""
    near = np.zeros(2048, np.uint32)
    for weight in (1, 2, 3):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.uint32)
        near[_syndromes(errors)] = errors
    errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), 4)], np.uint32)
    syndromes = _syndromes(errors)
    order = np.argsort(syndromes, kind="stable")
    counts = np.bincount(syndromes, minlength=2048)
    far = np.zeros((2048, 5), np.uint32)
    place = np.concatenate([np.arange(c) for c in counts])
    far[syndromes[order], place] = errors[order]
    return near, far, counts


def codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment value: index of the nearest codeword; indices of all within 4 bits (n x 6) and which of them exist."""
    near, far, counts = golay_tables()
    syndrome = _syndromes(segment)
    nearest = (segment ^ near[syndrome]) >> np.uint32(11)
    within = np.concatenate([nearest[:, None], (segment[:, None] ^ far[syndrome]) >> np.uint32(11)], axis=1)
    real = np.concatenate([np.ones((len(segment), 1), bool), np.arange(5)[None, :] < counts[syndrome][:, None]], axis=1)
    return nearest, within, real


def keys_of(fps: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(row, key) pairs of a batch of fingerprints: stored keys and looked-up keys, each as [rows, keys]."""
    segments = [(fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.uint32) for at, width in CUTS]
    found = [codewords(s) for s in segments]
    parity = [np.bitwise_count(s).astype(np.uint64) & np.uint64(1) for s in segments]
    rows = np.arange(len(fps))
    store: list[tuple] = []
    look: list[tuple] = []
    for case, (a, b) in enumerate(combinations(range(3), 2)):
        mark = np.uint64(case << 24)
        store.append((rows, mark | found[a][0].astype(np.uint64) << np.uint64(12) | found[b][0].astype(np.uint64)))
        pairs = mark | found[a][1].astype(np.uint64)[:, :, None] << np.uint64(12) | found[b][1].astype(np.uint64)[:, None, :]
        real = found[a][2][:, :, None] & found[b][2][:, None, :]
        look.append((np.broadcast_to(rows[:, None, None], real.shape)[real], pairs[real]))
    for a in range(3):
        b, c = (s for s in range(3) if s != a)
        exact = np.uint64(3 + a << 24) | segments[a].astype(np.uint64) << np.uint64(2) | parity[b] << np.uint64(1) | parity[c]
        store.append((rows, exact))
        look.append((rows, exact))
    return [np.concatenate(x) for x in zip(*store)], [np.concatenate(x) for x in zip(*look)]


def _keyed(fps: DataFrame) -> DataFrame:
    """key, fp and looked (0: stored, 1: looked up) of every different fingerprint."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            every = part.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(every), KEYED_ROWS):  # each row has some 110 keys
                own = every[at : at + KEYED_ROWS]
                for looked, (rows, keys) in enumerate(keys_of(own.view(np.uint64))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(own[rows]), pa.array(np.full(len(rows), looked, np.int8))], names=["key", "fp", "looked"]
                    )

    return fps.select("fp").mapInArrow(work, "key long, fp long, looked byte")


def forest(left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links: their components, with at most one link for each fingerprint."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    kept_left, kept_right = [], []
    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept_left.append(a)
            kept_right.append(b)
    return kept_left, kept_right


def bucket_links(parts: Iterator[pa.RecordBatch], max_bits: int = MAX_BITS, pairs_at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Verified links of rows sorted by (key, looked), as spanning forests of bounded stretches.

    A key's stored fingerprints stay in memory while its looked-up ones stream past; all of their pairs are
    compared, in stretches of bounded size, but only a forest of each stretch leaves the task.
    """
    key_before, kept = None, np.empty(0, np.int64)
    for part in parts:
        key, fp, looked = (part.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "looked"))
        if not len(key):
            continue
        stored_here = looked == 0
        stored_key, stored_fp = key[stored_here], fp[stored_here]
        if key_before is not None and key[0] == key_before and len(kept):
            stored_key = np.concatenate([np.full(len(kept), key_before), stored_key])
            stored_fp = np.concatenate([kept, stored_fp])
        look_key, look_fp = key[~stored_here], fp[~stored_here]
        first = np.searchsorted(stored_key, look_key, "left")
        counts = np.searchsorted(stored_key, look_key, "right") - first
        some = np.flatnonzero(counts)
        ends = np.cumsum(counts[some])
        at = 0
        while at < len(some):
            reach = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + pairs_at_once, "right")))
            rows = some[at:reach]
            n = counts[rows]
            place = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            a, b = np.repeat(look_fp[rows], n), stored_fp[place]
            close = (np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits) & (a != b)
            if close.any():
                left, right = forest(a[close], b[close])
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["u", "v"])
            at = reach
        key_before = key[-1]
        kept = stored_fp[stored_key == key_before]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """u, v: links that give the components of fingerprints at `max_bits` (up to 4) or fewer bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the segments are cut for at most {MAX_BITS} bits")
    spark = fps.sparkSession
    with batch_rows(spark, LINK_ROWS):
        keyed = _keyed(fps)
        dealt = keyed.repartition("key").sortWithinPartitions("key", "looked")
        return stored(dealt.mapInArrow(lambda parts: bucket_links(parts, max_bits), "u long, v long").distinct(), "simhash-links")


def components(found: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`found` (doc_id, fp and more) with component_id, the smallest identifier reachable by links."""
    fps = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected_components(links(fps, max_bits))
    rooted = fps.join(roots, fps["fp"] == roots["node"]).select("fp", "least", "root")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rooted.join(names, "root").select("fp", "component_id")
    alone = fps.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    return found.join(stored(linked.unionByName(alone), "components"), "fp")


def near_copies(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    found = components(stored(fingerprints(docs, size), "simhash"), max_bits)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

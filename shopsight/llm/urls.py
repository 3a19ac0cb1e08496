"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join of the possible hits.

A listed rule is (host, path, verdict): it fits its host and all subdomains if the path of the URL starts with the
rule's path. A URL thus has one candidate key for each suffix of its host labels and each path length in the list.
Candidates pass the Bloom filter (each key has one block of 512 bits and sets `BITS` of them), which fits in
`FILTER_BYTES` whatever the list's length: longer lists only let more candidates through. The rest meets the list in an
exact join on the key's text, so false positives go; the longest rule wins, of equal ones that with the longer host.

Null URLs and URLs without `://` have empty host and path; they fit no rule. Repeated rules of one key count once,
block before allow. Empty tables give empty results. Rows of the pages that repeat are judged each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopsight.llm.common import stored

BITS = 8
BITS_PER_KEY = 20
FILTER_BYTES = 64 << 20
BLOCK_WORDS = 8
SEPARATOR = "\u0001"
DEFAULT = "allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column, both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    after = F.regexp_replace(rest, r"(?s)^[^/?#]*", "")
    path = F.coalesce(F.regexp_extract(after, r"(?s)^([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit(SEPARATOR), path)


class BlockedFilter:
    """Bits of a blocked Bloom filter; keys are 64-bit hashes."""

    def __init__(self, blocks: int):
        self.words = np.zeros((blocks, BLOCK_WORDS), np.uint64)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each key and the words (keys x BLOCK_WORDS) that it sets there."""
        keys = keys.astype(np.int64).view(np.uint64)
        block = (keys >> np.uint64(32)) % np.uint64(len(self.words))
        masks = np.zeros((len(keys), BLOCK_WORDS), np.uint64)
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        for k in range(BITS):
            bit = mixed >> np.uint64(7 * k) & np.uint64(511)
            masks[np.arange(len(keys)), (bit >> np.uint64(6)).astype(int)] |= np.uint64(1) << (bit & np.uint64(63))
        return block.astype(np.int64), masks

    def add(self, keys: np.ndarray) -> None:
        block, masks = self.places(keys)
        np.bitwise_or.at(self.words, block, masks)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        block, masks = self.places(keys)
        return ((self.words[block] & masks) == masks).all(axis=1)


def build_filter(keys: DataFrame, blocks: int) -> BlockedFilter:
    """The filter of a column h. Blocks are dealt over tasks, each of which makes its part of the bits."""
    shape = BlockedFilter(blocks)

    def part(frames):
        for frame in frames:
            block, masks = BlockedFilter(blocks).places(frame["h"].to_numpy()) if len(frame) else (np.empty(0, int), np.empty((0, BLOCK_WORDS), np.uint64))
            own, place = np.unique(block, return_inverse=True)
            words = np.zeros((len(own), BLOCK_WORDS), np.uint64)
            np.bitwise_or.at(words, place, masks)
            yield pd.DataFrame({"block": own} | {f"w{k}": words[:, k].view(np.int64) for k in range(BLOCK_WORDS)})

    names = [f"w{k}" for k in range(BLOCK_WORDS)]
    schema = "block long, " + ", ".join(f"{n} long" for n in names)
    made = keys.select("h").mapInPandas(part, schema).groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names])
    for row in made.toLocalIterator():  # at most FILTER_BYTES altogether
        shape.words[row["block"]] = np.array([row[n] for n in names], np.int64).view(np.uint64)
    return shape


def judged(pages: DataFrame, listed: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (host and path of the rule that won, or null) and verdict of every page."""
    spark = pages.sparkSession
    key = _key(F.col("host"), F.col("path"))
    rules = listed.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select("host", "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = stored(rules.select(key.alias("key"), F.concat("host", "path").alias("rule"), F.length("host").alias("n_host"), "verdict"), "url-rules")
    n_rules = rules.count()
    lengths = [row[0] for row in rules.select((F.length("rule") - F.col("n_host")).alias("n")).distinct().collect()]
    blocks = max(1, min(FILTER_BYTES // (8 * BLOCK_WORDS), n_rules * BITS_PER_KEY // (64 * BLOCK_WORDS) + 1))
    shared = spark.sparkContext.broadcast(build_filter(rules.select(F.xxhash64("key").alias("h")), blocks))

    @F.pandas_udf("boolean")
    def may_be_listed(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.may_hold(h.to_numpy()))

    host, path = url_parts(F.col("url"))
    parts = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    parts = stored(parts, "url-parts")
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path"))
    many = parts.where("host <> ''").select("row", F.explode(suffixes).alias("host"), starts.alias("starts"), "path")
    many = many.select("row", "host", F.explode("starts").alias("n"), "path")
    candidates = many.select("row", _key(F.col("host"), F.substr(F.col("path"), F.lit(1), F.col("n"))).alias("key"))
    hits = candidates.where(may_be_listed(F.xxhash64("key"))).join(rules, "key")
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "n_host")).alias("best")
    won = hits.groupBy("row").agg(best)
    return parts.join(won, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )

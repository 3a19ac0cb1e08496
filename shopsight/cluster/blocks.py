"""Points in space-ordered blocks of bounded size, and work on pairs of blocks.

Neighbour counts, nearest neighbours and exact silhouettes need distances between points. Points are
ordered along a Z-curve and cut into blocks of a fixed number of rows, so a block is small however dense
its region is. Each block carries its bounding box; only block pairs whose boxes are close enough are
joined, and a task sees one pair at a time, as two arrays. Pairs of points are never emitted: a task
returns one row per point of the block (a count, a few distances, a sum).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shopsight.operators.ranking import global_rank

BLOCK_ROWS = 1024
FEW_SHARE = 16
MANY_TAKEN = 4
STRIPE_ROWS = 16_384
STRIPE_CELLS = 1 << 20
# Squares this many times the error bound of a matrix product give distances right to seven digits and more.
CLEAR_SQUARES = 1e6


def as_points(df: DataFrame, id_column: str, features: str = "features", extra: list[str] | None = None) -> DataFrame:
    """id, x (array) and any extra columns."""
    kind = df.schema[features].dataType
    x = F.col(features).cast("array<double>") if isinstance(kind, T.ArrayType) else vector_to_array(features)
    return df.select(F.col(id_column).cast("long").alias("id"), x.alias("x"), *(extra or []))


def z_order(lows: list[float], highs: list[float], max_dims: int = 8) -> Column:
    """Interleaved bits of the (first) coordinates, scaled to their range."""
    dims = min(len(lows), max_dims)
    bits = 48 // dims
    key = F.lit(0).cast("long")
    for i in range(dims):
        span = (highs[i] - lows[i]) or 1.0
        cell = F.floor((F.col("x")[i] - F.lit(lows[i])) / F.lit(span) * F.lit(float(2**bits - 1))).cast("long")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * dims + i))
    return key


@dataclass
class Blocks:
    """rows: block, ids, xs (flat), further arrays, lo and hi (bounding box), n. Persisted; release after use."""

    rows: DataFrame
    number: int
    lows: list[float]
    highs: list[float]

    def with_rows(self, rows: DataFrame) -> Blocks:
        return Blocks(rows, self.number, self.lows, self.highs)

    def release(self) -> None:
        self.rows.unpersist()


def ranked_blocks(points: DataFrame, block_rows: int | Callable[[int], int]) -> tuple[DataFrame, int, list[float], list[float]]:
    """(points with their block, number of blocks, lowest and highest coordinates); `block_rows` may depend on the dimensions.

    Points are ranked along the curve and cut every `block_rows` ranks. Points sharing a cell of the curve are ranked by
    a hash, so a crowded cell is cut into blocks like any other place.
    """
    summary = Summarizer.metrics("min", "max", "count").summary(array_to_vector("x")).alias("s")
    info = points.select(summary).select("s.*").first()
    lows, highs = list(info["min"]), list(info["max"])
    size = block_rows(len(lows)) if callable(block_rows) else block_rows
    number = max(1, math.ceil(info["count"] / size))
    if number > 1:
        keyed = points.withColumns({"_z": z_order(lows, highs), "_h": F.xxhash64("id")})
        ranked = global_rank(keyed, ["_z", "_h", "id"], "_rank", rows_per_range=size * 64, rows=info["count"])
        numbered = ranked.withColumn("block", F.floor((F.col("_rank") - 1) / size))
    else:
        numbered = points.withColumn("block", F.lit(0).cast("long"))
    return numbered, number, lows, highs


def make_blocks(points: DataFrame, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Blocks of at most `block_rows` points that follow each other along the curve."""
    extra = [c for c in points.columns if c not in ("id", "x")]
    numbered, number, lows, highs = ranked_blocks(points, block_rows)
    grouped = numbered.groupBy("block").agg(
        F.collect_list(F.struct("id", "x", *extra)).alias("rows"),
        F.array(*[F.min(F.col("x")[i]) for i in range(len(lows))]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(len(lows))]).alias("hi"),
        F.count("*").alias("n"),
    )
    arrays = [F.col("rows")[c].alias(f"{c}s") for c in ["id", *extra]]
    rows = grouped.select("block", *arrays, F.flatten(F.col("rows")["x"]).alias("xs"), "lo", "hi", "n")
    return Blocks(rows.persist(), number, lows, highs)


def all_pairs(blocks: Blocks) -> DataFrame:
    """Every ordered pair of blocks, for measures defined over all distances."""
    partners = F.sequence(F.lit(0).cast("long"), F.lit(blocks.number - 1).cast("long"))
    return blocks.rows.select(F.col("block").alias("a"), F.explode(partners).alias("b"))


def make_stripes(points: DataFrame, stripe_rows: int | None = None) -> Blocks:
    """Points dealt to blocks by a hash, without boxes: for measures defined over all distances, where no place is left out.

    A block holds up to about STRIPE_CELLS numbers, fewer if there would be too few pairs of blocks for the cores.
    """
    extra = [c for c in points.columns if c not in ("id", "x")]
    info = points.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims")).first()
    if stripe_rows is None:
        most = max(BLOCK_ROWS, min(STRIPE_ROWS, STRIPE_CELLS // max(1, info["dims"] or 1)))
        wanted = math.ceil(math.sqrt(8 * points.sparkSession.sparkContext.defaultParallelism))
        number = max(math.ceil(info["n"] / most), min(wanted, math.ceil(info["n"] / BLOCK_ROWS)), 1)
    else:
        number = max(1, math.ceil(info["n"] / stripe_rows))
    numbered = points.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(number).cast("long")))
    grouped = numbered.groupBy("block").agg(F.collect_list(F.struct("id", "x", *extra)).alias("rows"), F.count("*").alias("n"))
    arrays = [F.col("rows")[c].alias(f"{c}s") for c in ["id", *extra]]
    rows = grouped.select("block", *arrays, F.flatten(F.col("rows")["x"]).alias("xs"), "n")
    return Blocks(rows.persist(), number, [], [])


def every_pair(blocks: Blocks, columns: list[str]) -> DataFrame:
    """Every unordered pair of blocks (a <= b) with the contents of both, dealt by the pair and not by one of its blocks."""
    last = F.lit(blocks.number - 1).cast("long")
    block = F.col("block")
    a = blocks.rows.select(block.alias("a"), F.explode(F.sequence(block, last)).alias("b"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = blocks.rows.select(block.alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), block)).alias("a"), *[F.col(c).alias(f"{c}_b") for c in columns])
    tasks = min(10_000, blocks.number * (blocks.number + 1) // 2)
    return a.repartition(tasks, "a", "b").join(b.repartition(tasks, "a", "b"), ["a", "b"])


def paired(blocks: Blocks, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Attach the contents of both blocks to every pair.

    The pairs, two numbers each, are spread over all cores first: few blocks still mean much work.
    """
    cores = blocks.rows.sparkSession.sparkContext.defaultParallelism
    pairs = pairs.repartition(max(1, min(blocks.number**2, 4 * cores)))
    a = blocks.rows.select(F.col("block").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = blocks.rows.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.join(a, "a").join(b, "b")


def distances(xs_a: np.ndarray, n_a: int, xs_b: np.ndarray, n_b: int) -> np.ndarray:
    """Euclidean distances between two flat blocks, one coordinate at a time."""
    a, b = np.asarray(xs_a, float).reshape(n_a, -1), np.asarray(xs_b, float).reshape(n_b, -1)
    total = np.zeros((n_a, n_b))
    for i in range(a.shape[1]):
        total += np.subtract.outer(a[:, i], b[:, i]) ** 2
    return np.sqrt(total)


def _exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of some pairs, to the last bit as `distances` has them."""
    total = np.zeros(len(i))
    for c in range(a.shape[1]):
        total += (a[i, c] - b[j, c]) ** 2
    return np.sqrt(total)


def _squares(xs_a: np.ndarray, n_a: int, xs_b: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Both blocks, their squared distances by one matrix product, and a bound of the error of these."""
    a, b = np.asarray(xs_a, float).reshape(n_a, -1), np.asarray(xs_b, float).reshape(n_b, -1)
    own_a, own_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    slack = 4 * (a.shape[1] + 4) * np.finfo(float).eps * (own_a.max() + own_b.max())
    one = np.ones
    return a, b, np.column_stack([a, own_a, one(n_a)]) @ np.column_stack([-2 * b, one(n_b), own_b]).T, float(slack)


def product_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product; those too small for it to tell are measured one by one."""
    centre = b.mean(axis=0)
    p, q = a - centre, b - centre
    own_p, own_q = (p * p).sum(axis=1), (q * q).sum(axis=1)
    clear = CLEAR_SQUARES * 4 * (a.shape[1] + 4) * np.finfo(float).eps * (own_p.max() + own_q.max())
    squares = np.column_stack([p, own_p, np.ones(len(p))]) @ np.column_stack([-2 * q, np.ones(len(q)), own_q]).T
    small = squares <= clear
    few = np.count_nonzero(small)
    if few > small.size // FEW_SHARE or not np.isfinite(clear):
        return distances(a.ravel(), len(a), b.ravel(), len(b))
    i, j = np.nonzero(small) if few else ([], [])
    squares[i, j] = 0.0
    gaps = np.sqrt(squares, out=squares)
    if few:
        gaps[i, j] = _exact(a, b, i, j)
    return gaps


def within(xs_a: np.ndarray, n_a: int, xs_b: np.ndarray, n_b: int, reach: float) -> np.ndarray:
    """Which points are at most `reach` apart, exactly: pairs whose squares are too close to tell are compared by themselves."""
    a, b, squares, slack = _squares(xs_a, n_a, xs_b, n_b)
    slack += 8 * np.finfo(float).eps * (a.shape[1] + 4) * reach * reach
    near = squares <= reach * reach - slack
    i, j = np.divmod(np.flatnonzero((squares <= reach * reach + slack) > near), n_b)
    if len(i) > near.size // FEW_SHARE or not np.isfinite(slack):
        return distances(xs_a, n_a, xs_b, n_b) <= reach
    near[i, j] = _exact(a, b, i, j) <= reach
    return near


def nearest_distances(xs_a: np.ndarray, n_a: int, xs_b: np.ndarray, n_b: int, weights: np.ndarray, k: int, near: np.ndarray | None = None) -> np.ndarray:
    """The k smallest distances of every point of a to points of b, exact and ascending, copies counted, padded with infinity.

    `near` holds smaller or equal numbers of distances known already, which take part. Those that may be among the k
    nearest are taken by one matrix product; only they are measured one by one.
    """
    a, b, squares, slack = _squares(xs_a, n_a, xs_b, n_b)
    near = np.full((n_a, k), np.inf) if near is None else near
    limit = near[:, -1] ** 2 * (1 + 1e-12) + slack
    taken = squares <= limit[:, None]
    many = np.flatnonzero(np.count_nonzero(taken, axis=1) > MANY_TAKEN * k)
    if len(many):
        last = min(k, n_b) - 1
        limit = np.minimum(limit[many], np.partition(squares[many], last, axis=1)[:, last] + 2 * slack)
        taken[many] = squares[many] <= limit[:, None]
    i, j = np.divmod(np.flatnonzero(taken), n_b)
    if len(i) > k * n_a + squares.size // FEW_SHARE or not np.isfinite(slack):
        i, j = (side.ravel() for side in np.indices((n_a, n_b)))
    gaps, copies = _exact(a, b, i, j), np.minimum(weights, k)[j]
    met = np.unique(i)
    i = np.concatenate([np.repeat(met, k), np.repeat(i, copies)])
    gaps = np.concatenate([near[met].ravel(), np.repeat(gaps, copies)])
    order = np.lexsort((gaps, i))
    i, gaps = i[order], gaps[order]
    place = np.arange(len(i)) - np.searchsorted(i, np.arange(n_a))[i]
    out = near.copy()
    out[i[place < k], place[place < k]] = gaps[place < k]
    return out


def on_pairs(rows: DataFrame, work: Callable[[pd.Series], pd.DataFrame], schema: str) -> DataFrame:
    """Run `work` on one pair of blocks at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                out = work(row)
                if out is not None and len(out):
                    yield out

    return rows.mapInPandas(run, schema)

"""Splits: by time, by hash of a customer, stratified at random, and expanding windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.operators.ranking import global_rank, order_statistics
from shopsight.functions.values import as_column

SPLITS = ("train", "val", "test")


def _checked(ratios: Sequence[float]) -> None:
    if not math.isclose(sum(ratios), 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError(f"ratios must sum to 1, got {sum(ratios)}")


def cut_points(df: DataFrame, ts: str, id_column: str, ranks: Sequence[int]) -> dict[int, tuple]:
    """The (timestamp, id) found at each 0-based rank of the order (timestamp, id)."""
    cuts: dict[int, tuple] = {}
    micros = df.select(F.unix_micros(ts).alias("t"), F.col(id_column).alias("i"))
    for rank, (t, before) in order_statistics(micros, "t", ranks).items():
        tied = micros.where(F.col("t") == t)
        cuts[rank] = (t, order_statistics(tied, "i", [rank - before])[rank - before][0])
    return cuts


def _before(ts: Column, id_column: Column, cut: tuple) -> Column:
    t, i = cut
    micros = F.unix_micros(ts)
    return (micros < F.lit(t)) | ((micros == F.lit(t)) & (id_column < F.lit(i)))


def assign_time_split(
    orders: DataFrame,
    train: float = 0.70,
    val: float = 0.15,
    test: float = 0.15,
    ts: str = "order_purchase_timestamp",
    id_column: str = "order_id",
    split_column: str = "split",
) -> DataFrame:
    """Oldest rows to train, newest to test; equal timestamps are ordered by id, missing ones go last.

    Only the two rows at the cuts are searched for; the assignment itself is a projection, so no row is
    shuffled or sorted.
    """
    _checked((train, val, test))
    n = orders.count()
    ends = [int(n * train), int(n * (train + val))]
    cuts = cut_points(orders, ts, id_column, ends)
    t, i = F.col(ts), F.col(id_column)
    known = t.isNotNull()
    first = _before(t, i, cuts[ends[0]]) if ends[0] in cuts else known
    second = _before(t, i, cuts[ends[1]]) if ends[1] in cuts else known
    label = F.when(known & first, SPLITS[0]).when(known & second, SPLITS[1]).otherwise(SPLITS[2])
    return orders.withColumn(split_column, label)


def apply_split(df: DataFrame, assigned: DataFrame, id_column: str = "order_id") -> DataFrame:
    """Give every row the split of its id; rows of unassigned ids are left out."""
    return df.join(assigned.select(id_column, "split").distinct(), id_column, "inner")


def rows_of_split(df: DataFrame, assigned: DataFrame, split: str, id_column: str = "order_id") -> DataFrame:
    """Rows whose id belongs to one split (membership only, no columns added)."""
    ids = assigned.where(F.col("split") == split).select(id_column)
    return df.join(ids, id_column, "left_semi")


def split_overlaps(assigned: DataFrame, id_column: str = "order_id") -> DataFrame:
    """Ids shared by each pair of splits; all counts must be 0."""
    parts = {s: assigned.where(F.col("split") == s).select(id_column) for s in SPLITS}
    rows = None
    for a, b in ((0, 1), (0, 2), (1, 2)):
        shared = parts[SPLITS[a]].intersect(parts[SPLITS[b]]).agg(F.count("*").alias("shared_ids"))
        row = shared.select(F.lit(f"{SPLITS[a]}-{SPLITS[b]}").alias("pair"), "shared_ids")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def assign_stratified_split(
    df: DataFrame,
    id_column: str,
    label: str,
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    seed: int = 42,
    split_column: str = "split",
) -> DataFrame:
    """Random split with the ratios kept within every class (exact to one row)."""
    _checked(ratios)
    shuffled = df.withColumn("_h", F.xxhash64(F.col(id_column).cast("string"), F.lit(seed)))
    ranked = global_rank(shuffled, ["_h"], "_rank", within=[label])
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    ranked = ranked.join(sizes, label)
    first = F.floor(F.col("_size") * ratios[0])
    second = F.floor(F.col("_size") * (ratios[0] + ratios[1]))
    name = F.when(F.col("_rank") <= first, SPLITS[0]).when(F.col("_rank") <= second, SPLITS[1]).otherwise(SPLITS[2])
    return ranked.withColumn(split_column, name).drop("_h", "_rank", "_size")


def assign_customer_split(
    df: DataFrame,
    customer: str = "customer_unique_id",
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    seed: int = 42,
    split_column: str = "split",
) -> DataFrame:
    """All rows of a customer in one split, from a hash bucket of the customer: no shuffle."""
    _checked(ratios)
    bucket = F.pmod(F.xxhash64(F.col(customer).cast("string"), F.lit(seed)), F.lit(10_000))
    first, second = round(10_000 * ratios[0]), round(10_000 * (ratios[0] + ratios[1]))
    name = F.when(bucket < first, SPLITS[0]).when(bucket < second, SPLITS[1]).otherwise(SPLITS[2])
    return df.withColumn(split_column, name)


def stratified_folds(
    df: DataFrame, id_column: str, label: str, folds: int = 5, seed: int | None = 42, fold_column: str = "fold"
) -> DataFrame:
    """Fold numbers 0..folds-1 dealt out in random order within each class; seed None deals by id."""
    key = as_column(id_column) if seed is None else F.xxhash64(F.col(id_column).cast("string"), F.lit(seed))
    ranked = global_rank(df.withColumn("_h", key), ["_h"], "_rank", within=[label])
    return ranked.withColumn(fold_column, ((F.col("_rank") - 1) % folds).cast("int")).drop("_h", "_rank")


def expanding_folds(
    df: DataFrame, ts: str, id_column: str, folds: int = 5, block_column: str = "block"
) -> DataFrame:
    """Blocks 0..folds in time order. Fold f trains on blocks up to f and validates on block f + 1.

    Every validation block has n // (folds + 1) rows; the rest belong to block 0.
    """
    n = df.count()
    size = n // (folds + 1)
    ends = [n - size * (folds - f) for f in range(folds)]
    cuts = cut_points(df, ts, id_column, ends)
    t, i = F.col(ts), F.col(id_column)
    block = F.lit(0)
    for end in ends:
        passed = ~_before(t, i, cuts[end]) if end in cuts else F.lit(False)
        block = block + F.when(passed, 1).otherwise(0)
    return df.withColumn(block_column, block)


def undersample(df: DataFrame, id_column: str, label: str, seed: int = 42) -> DataFrame:
    """Keep as many rows of every class as the smallest class has, chosen by hash order."""
    smallest = df.groupBy(label).count().agg(F.min("count")).first()[0]
    shuffled = df.withColumn("_h", F.xxhash64(F.col(id_column).cast("string"), F.lit(seed)))
    ranked = global_rank(shuffled, ["_h"], "_rank", within=[label])
    return ranked.where(F.col("_rank") <= smallest).drop("_h", "_rank")

"""Mixing sources to target weights by a curriculum that varies over training.

Each source has a weight schedule: points (time, weight) between 0 and 1, straight between them. Its integral is the
source's weight. Targets share the words of all documents by these weights; a target stops at `MAX_REPEATS` times the
source's words, and what is over is shared again by weight until no target is above.

A source repeats its documents in the order of a hash until its target is reached: a copy belongs to the mix if its
middle word lies before the target, so a source's taken words differ from its target by at most half a document, and
no document is taken more than `MAX_REPEATS` times. The schedule, scaled to the target and integrated, is the words a
source has given by a time; its inverse at a copy's middle word is the copy's training position in [0, 1]. Copies are
range-sorted by position; `start` counts the words of the mix before a copy.

Work. Texts are only measured where they are scanned. Running sums are taken inside buckets of the hash, whose totals are a
small table, so that a source with a third of all rows has as many tasks as its rows need; rows that are equal in
identifier, source and size are one row with a count until the end. Reruns give the same rows.

Null texts are empty and of size 0; documents of size 0 ride along without words. A null source is a source of its own, the
last one. Null and repeated identifiers are rows like others. Empty tables give empty results; further columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopsight.llm.common import stored, text_column

MAX_REPEATS = 3
BUCKET_ROWS = 4_096
RANGE_ROWS = 200_000
MAX_BITS = 24
HEX_DIGITS = 15
Schedule = Sequence[tuple[float, float]]
# Of the sources in order, repeating: their weights fall, stay and rise over training, and integrate to 5, 2 and 1.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 6.0), (1.0, 4.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.0), (0.5, 1.0), (1.0, 2.0)))


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def checked(schedule: Schedule) -> Schedule:
    times = [t for t, _ in schedule]
    if len(times) < 2 or times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])):
        raise ValueError("a schedule goes from time 0 to 1 in ascending steps")
    if any(w < 0 for _, w in schedule) or integral(schedule) <= 0:
        raise ValueError("weights are not negative and not all zero")
    return schedule


def time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which a source has given `share` (0 to 1) of its words: the integrated schedule, inverted piece by piece."""
    total, done = integral(schedule), 0.0
    out = F.lit(1.0)
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        if area > 0:
            pieces.append((done / total, (done + area) / total, t0, t1, w0, (w1 - w0) / (t1 - t0)))
        done += area
    for low, high, t0, t1, w0, slope in reversed(pieces):
        need = (share - F.lit(low)) * F.lit(total)
        # w0 x + slope x^2 / 2 = need, in the form that holds for slope 0 too
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * need, F.lit(0.0)))
        step = F.when(need <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * need / (F.lit(w0) + root))
        out = F.when(share < F.lit(high), F.least(F.lit(t0) + step, F.lit(t1))).otherwise(out)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and h (order within the source) of every row."""
    text = text_column()
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("long").alias("h"),
    )


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, kind (place of its schedule), source_size and target, from rows of source and size.

    The table has one row a source. Targets fill up together: `level` words for each unit of weight. Sources that would
    be above their limit stand at it and the level rises for the others, until none is above.
    """
    weights = [integral(checked(s)) for s in schedules]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = totals.withColumn("kind", F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("kind") + 1)
    sources = stored(numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_repeats), "mix-sources")
    level, standing = 0.0, -1
    while True:
        full = F.col("limit") < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("limit")).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"), F.count(F.when(full, 1)).alias("n"),
        ).first()
        if not row["all"] or row["n"] == standing or not row["open"]:
            break
        level, standing = (row["all"] - row["held"]) / row["open"], row["n"]
    target = F.when(F.col("limit") < F.lit(level) * F.col("weight"), F.col("limit").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.select("source", "kind", "source_size", target.alias("target"))


def assigned(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """row (any number), doc_id, source, h, size, source_size, target, kind, at (words of its source before it) and copies of every row of `docs`."""
    rows = stored(measured(docs), "mix-sizes")
    targets = source_targets(rows, schedules, max_repeats)
    n = rows.count()
    bits = min(MAX_BITS, max(0, -(-n // BUCKET_ROWS) - 1).bit_length())
    alike = rows.groupBy("doc_id", "source", "h", "size").agg(F.count("*").alias("times"))
    alike = alike.withColumn("bucket", F.shiftright("h", 4 * HEX_DIGITS - bits))
    alike = stored(alike, "mix-rows")
    part = ["source", "bucket"]
    sums = alike.groupBy(*part).agg(F.sum(F.col("size") * F.col("times")).alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*part).orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = alike.withColumn("own", F.coalesce(F.sum(F.col("size") * F.col("times")).over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    placed = placed.join(sums, same).drop("_source", "_bucket")
    given = targets.select(F.col("source").alias("_source"), "kind", "source_size", "target")
    placed = placed.join(given, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    every = placed.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    every = every.withColumn("at", F.col("offset") + F.col("own") + F.col("turn") * F.col("size"))
    copies = F.lit(0)
    for turn in range(max_repeats):
        middle = F.lit(2) * (F.col("at") + F.lit(turn) * F.col("source_size")) + F.col("size")
        copies = copies + F.when(middle < F.lit(2.0) * F.col("target"), 1).otherwise(0)
    return every.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "h", "size", "source_size", "target", "kind", "at", copies.alias("copies"))


def mixed(rows: DataFrame, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """Every copy of `assigned` rows in training order: their columns, turn, position and start (words of the mix before it)."""
    every = rows.where("copies > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    share = (F.col("at") + F.col("turn") * F.col("source_size") + F.col("size") / 2.0) / F.col("target")
    position = F.lit(None).cast("double")
    for kind, schedule in enumerate(schedules):
        position = F.when(F.col("kind") == kind, time_of(share, schedule)).otherwise(position)
    every = every.withColumn("position", position)
    order = ["position", "h", F.col("doc_id").asc_nulls_last(), F.col("source").asc_nulls_last(), "at", "turn"]
    ranges = max(1, -(-every.count() // RANGE_ROWS))
    ordered = every.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    ordered = stored(ordered, "mix-ordered")
    sums = ordered.groupBy("range").agg(F.sum("size").alias("words"))
    earlier = sums.select("range", F.coalesce(F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    started = ordered.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return started.join(earlier, "range").withColumn("start", F.col("before") + F.col("within")).drop("within", "before", "range")


def taken(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, first_position and first_start of every row of `docs`."""
    rows = stored(assigned(docs, schedules, max_repeats), "mix-assigned")
    own = ["doc_id", "source", "size", "source_size", "target"]
    found = mixed(rows, schedules).groupBy("row").agg(
        *[F.first(c).alias(c) for c in own], F.sum("size").alias("taken"), F.count("*").cast("int").alias("copies"), F.min("position").alias("first_position"), F.min("start").alias("first_start")
    )
    none = rows.where("copies = 0").select(*own, F.lit(0).cast("long").alias("taken"), F.lit(0).alias("copies"), F.lit(None).cast("double").alias("first_position"), F.lit(None).cast("long").alias("first_start"))
    return found.drop("row").unionByName(none)

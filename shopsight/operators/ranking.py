"""Order statistics and running totals that never sort a whole table in one task.

* `order_statistics`: exact values at given ranks by narrowing brackets. Each pass is one map-side
  aggregation over the rows, without a shuffle of them.
* `quantile_table`: exact interpolated quantiles, overall or per group.
* `running_totals`: global ranks and cumulative sums. Rows are cut into value ranges with literal
  bounds, ranges are summed, and a window runs inside each range only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shopsight.functions.values import as_column

# Distinct values one aggregation buffer or one sorted window may hold.
BUFFER_VALUES = 1_000_000
ROWS_PER_RANGE = 1_000_000
ACCURACY = 10_000
# More ranks than this are looked up together in this many ranges.
FEW_RANKS = 8
SHARED_RANGES = 4_000


def _text_bounds(df: DataFrame, key: str, spot: float) -> tuple:
    """Values some way below and above a relative position, from a small sample; None means open."""
    sample = sorted(r[0] for r in df.select(key).orderBy(F.rand(17)).limit(2_000).collect())
    margin = 0.06
    pick = lambda p: sample[min(len(sample) - 1, int(p * len(sample)))]
    return (pick(spot - margin) if spot > margin else None, pick(spot + margin) if spot < 1 - margin else None)


def _inside(key: Column, low, high) -> Column:
    """Strictly between the bounds: a bound's own value was counted when it was set."""
    tests = []
    if low is not None:
        tests.append(key > F.lit(low))
    if high is not None:
        tests.append(key < F.lit(high))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def _narrowed(values: DataFrame, state: Mapping[int, tuple], wide: Sequence[int]) -> tuple[dict[int, tuple], dict[int, tuple]]:
    """(answers, new brackets) of the ranks in `wide`, whose brackets hold too many values.

    New bounds are values that occur inside the old bracket. A rank that falls on one is answered; else the bound
    is left out of the new bracket, so that every round removes at least one value. All ranks share one aggregation
    for the bounds (numbers) and one for the counts.
    """
    k = F.col("k")
    inside = {r: _inside(k, *state[r][:2]) for r in wide}
    spots = {r: (r - state[r][2]) / max(1, state[r][3] - 1) for r in wide}
    if isinstance(values.schema["k"].dataType, T.StringType):
        bounds = {r: _text_bounds(values.where(inside[r]), "k", spots[r]) for r in wide}
    else:
        margin = 4.0 / ACCURACY
        around = lambda p: [max(0.0, p - margin), min(1.0, p + margin)]
        found = values.agg(*[F.percentile_approx(F.when(inside[r], k), around(spots[r]), ACCURACY).alias(f"q{r}") for r in wide]).first()
        bounds = {r: tuple(found[f"q{r}"]) for r in wide}
    cuts = {r: sorted({b for b in bounds[r] if b is not None}) for r in wide}
    counts = [
        F.count_if(inside[r] & test).alias(f"{kind}{r}_{i}")
        for r in wide
        for i, cut in enumerate(cuts[r])
        for kind, test in (("less", k < F.lit(cut)), ("same", k == F.lit(cut)))
    ]
    counted = values.agg(*counts).first() if counts else {}
    answers, brackets = {}, {}
    for r in wide:
        low, high, before, rows = state[r]
        if not cuts[r]:
            raise AssertionError(f"no bound found for rank {r}")
        seen = before
        for i, cut in enumerate(cuts[r]):
            below = before + counted[f"less{r}_{i}"]
            if r < below:
                brackets[r] = (low, cut, seen, below - seen)
                break
            seen, low = below + counted[f"same{r}_{i}"], cut
            if r < seen:
                answers[r] = (cut, below)
                break
        else:
            brackets[r] = (low, high, seen, before + rows - seen)
    return answers, brackets


def _shared(values: DataFrame, ranks: Sequence[int], buffer_values: int) -> dict[int, tuple]:
    """Answers of many ranks of a numeric key at once: ranges are counted, and only those that hold a rank are sorted, each for itself.

    Three passes over the rows, whatever the number of ranks. Ranks of ranges with too many distinct values are left out.
    """
    probs = [i / SHARED_RANGES for i in range(1, SHARED_RANGES)]
    cuts = values.agg(F.percentile_approx("k", probs, max(ACCURACY, 4 * SHARED_RANGES)).alias("q")).first()["q"]
    bounds = sorted({float(c) for c in cuts if math.isfinite(c)})
    numbered = _range_index(values.withColumn("_x", F.col("k").cast("double")), "_x", bounds, "_range").select("k", "_range")
    sizes = {row["_range"]: row["n"] for row in numbered.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    ends = np.cumsum([sizes[r] for r in sorted(sizes)])
    own: dict[float, list[int]] = {}
    start: dict[float, int] = {}
    for rank in ranks:
        at = int(np.searchsorted(ends, rank, "right"))
        place = sorted(sizes)[at]
        start[place] = int(ends[at]) - sizes[place]
        own.setdefault(place, []).append(rank - start[place])
    large = [place for place in own if sizes[place] > buffer_values]
    if large:
        many = numbered.where(F.col("_range").isin(large)).groupBy("_range").agg(F.approx_count_distinct("k").alias("d")).where(F.col("d") > buffer_values)
        for row in many.collect():
            del own[row["_range"]]
    if not own:
        return {}
    wanted = F.broadcast(values.sparkSession.createDataFrame(list(own.items()), "_range double, _ranks array<long>"))
    counts = numbered.where(F.col("_range").isin(list(own))).groupBy("_range", "k").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_range").orderBy("k"))
    hits = counts.withColumn("upto", upto).join(wanted, "_range").withColumn("below", F.col("upto") - F.col("n"))
    hits = hits.withColumn("_rank", F.explode(F.filter("_ranks", lambda r: (r >= F.col("below")) & (r < F.col("upto")))))
    return {start[h["_range"]] + h["_rank"]: (h["k"], start[h["_range"]] + h["below"]) for h in hits.collect()}


def order_statistics(
    df: DataFrame, key: Column | str, ranks: Sequence[int], buffer_values: int = BUFFER_VALUES
) -> dict[int, tuple]:
    """{rank: (value, rows strictly before that value)} for 0-based ranks over the non-null keys."""
    values = df.select(as_column(key).alias("k")).where(F.col("k").isNotNull())
    total = values.count()
    wanted = sorted({r for r in ranks if 0 <= r < total})
    answer: dict[int, tuple] = {}
    if len(wanted) > FEW_RANKS and isinstance(values.schema["k"].dataType, T.DoubleType):
        answer = _shared(values, wanted, buffer_values)
    # rank -> (low, high, rows before low, rows inside)
    state = {r: (None, None, 0, total) for r in wanted if r not in answer}
    k = F.col("k")
    while state:
        if any(s[3] > buffer_values for s in state.values()):
            distinct = values.agg(
                *[F.approx_count_distinct(F.when(_inside(k, s[0], s[1]), k)).alias(f"d{r}") for r, s in state.items()]
            ).first()
            wide = [r for r in state if distinct[f"d{r}"] > buffer_values]
        else:
            wide = []
        if wide:
            answers, brackets = _narrowed(values, state, wide)
            answer.update(answers)
            state = {r: brackets.get(r, s) for r, s in state.items() if r not in answers}
        for r in [r for r in state if r not in wide]:
            low, high, before, _ = state.pop(r)
            counts = values.where(_inside(k, low, high)).groupBy("k").agg(F.count("*").alias("n"))
            # One sorted window, over at most `buffer_values` distinct values.
            upto = F.sum("n").over(Window.orderBy("k"))
            hit = (
                counts.withColumn("upto", upto)
                .where(F.col("upto") > r - before)
                .orderBy("k")
                .limit(1)
                .first()
            )
            answer[r] = (hit["k"], before + hit["upto"] - hit["n"])
    return answer


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    buffer_values: int = BUFFER_VALUES,
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per (group, column): by..., column, q (array).

    Groups whose values fit an aggregation buffer use one exact aggregation. Larger groups are found
    by a count first and go through `order_statistics`.
    """
    by, probs = list(by), [float(p) for p in probs]
    spark = df.sparkSession
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    arrays = [F.percentile(c, probs).alias(c) for c in columns]
    if by:
        sizes = numbers.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > buffer_values)
        large = [tuple(r[b] for b in by) for r in sizes.collect()]
    else:
        large = [()] if numbers.count() > buffer_values else []

    def _is(group: tuple) -> Column:
        tests = [F.col(b).eqNullSafe(F.lit(v)) for b, v in zip(by, group)]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    rest = numbers
    for group in large:
        rest = rest.where(~_is(group))
    wide = rest.groupBy(*by).agg(*arrays)
    out = wide.unpivot(by, list(columns), "column", "q")
    if not large:
        return out
    rows = []
    for group in large:
        part = numbers.where(_is(group))
        for c in columns:
            n = part.where(F.col(c).isNotNull()).count()
            spots = [p * (n - 1) for p in probs]
            need = {int(math.floor(h)) for h in spots} | {int(math.ceil(h)) for h in spots}
            got = order_statistics(part, c, sorted(need), buffer_values) if n else {}
            q = []
            for h in spots:
                lo, hi = math.floor(h), math.ceil(h)
                q.append(None if not n else got[lo][0] + (got[hi][0] - got[lo][0]) * (h - lo))
            rows.append((*group, c, q if n else None))
    exact = spark.createDataFrame(rows, out.schema)
    return exact if not by else out.unionByName(exact)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keep: bool = True
) -> dict[str, list | None]:
    """Fitted quantiles on the driver: one short list per column.

    Exact quantiles take several passes. With `keep` the columns asked for (only those) are kept meanwhile,
    so that a frame built by joins is not built again per pass; a plain scan does not need it.
    """
    columns = list(columns)
    if not columns:
        return {}
    narrow = df.select(*columns)
    if keep:
        narrow = narrow.persist()
    got = {r["column"]: r["q"] for r in quantile_table(narrow, columns, probs).collect()}
    if keep:
        narrow.unpersist()
    return {c: got.get(c) for c in columns}


def medians(df: DataFrame, columns: Sequence[str], keep: bool = True) -> dict[str, float | None]:
    return {c: (q[0] if q else None) for c, q in quantiles(df, columns, [0.5], keep).items()}


def null_safe_left(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on `keys` in which null meets null; `table` has one row for each combination of them."""
    other = table.select(*[F.col(k).alias(f"_same_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    return df.join(other, same, "left").drop(*[f"_same_{k}" for k in keys])


def _range_index(df: DataFrame, source: str, bounds: Sequence[float], target: str) -> DataFrame:
    edges = [-math.inf, *bounds, math.inf]
    return Bucketizer(splits=edges, inputCol=source, outputCol=target, handleInvalid="keep").transform(df)


def _as_number(df: DataFrame, key: Column | str) -> Column:
    """A numeric or timestamp key as a double; order is kept."""
    key = as_column(key)
    kind = df.select(key.alias("x")).schema["x"].dataType
    return (F.unix_micros(key) if isinstance(kind, T.TimestampType) else key).cast("double")


def cut_ranges(df: DataFrame, key: Column | str, name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add the number of the value range a key falls in; ranges hold about `rows_per_range` rows."""
    frame = df.withColumn("_key", _as_number(df, key))
    ranges = min(10_000, max(1, math.ceil(frame.count() / rows_per_range)))
    bounds = []
    if ranges > 1:
        probs = [i / ranges for i in range(1, ranges)]
        bounds = frame.agg(F.percentile_approx("_key", probs, max(ACCURACY, 10 * ranges)).alias("q")).first()["q"]
    bounds = sorted(set(bounds or []))
    frame = _range_index(frame, "_key", bounds, name) if bounds else frame.withColumn(name, F.lit(0.0))
    return frame.drop("_key")


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    within: Sequence[str] = (),
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> DataFrame:
    """Add, per name in `sums`, the total of that expression over all rows up to and including this one.

    The order is (order_by[0], order_by[1], ...) inside each `within` group; the first key is numeric or
    a timestamp. A value of the first key that fills a range of its own is cut further by the second key
    (also numeric), so a third of all rows sharing one value still spreads over many tasks.
    """
    within = list(within)
    sign = -1.0 if descending else 1.0
    n = df.count() if rows is None else rows
    ranges = min(10_000, max(1, math.ceil(n / rows_per_range)))
    keys = [as_column(c) for c in order_by]
    order = [k.desc() if descending else k.asc() for k in keys]
    if ranges == 1:
        # The whole table fits one range.
        all_rows = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({s: F.sum(as_column(e)).over(all_rows) for s, e in sums.items()})
    frame = df.withColumn("_k1", _as_number(df, keys[0]) * F.lit(sign))
    if len(keys) > 1:
        frame = frame.withColumn("_k2", _as_number(df, keys[1]) * F.lit(sign))
    heavy: dict[float, list[float]] = {}
    probs = [i / ranges for i in range(1, ranges)]
    cuts = frame.agg(F.percentile_approx("_k1", probs, max(ACCURACY, 10 * ranges)).alias("q")).first()["q"] or []
    bounds = sorted(set(cuts))
    repeated = sorted({v for v, times in Counter(cuts).items() if times > 1})
    if repeated and len(keys) > 1:
        found = (
            frame.where(F.col("_k1").isin(repeated))
            .groupBy("_k1")
            .agg(F.percentile_approx("_k2", probs, max(ACCURACY, 10 * ranges)).alias("q"))
            .collect()
        )
        # A value met c times among the cuts holds about c ranges of rows and is cut about c times.
        times = Counter(cuts)
        heavy = {r["_k1"]: sorted(set(r["q"][:: max(1, len(r["q"]) // times[r["_k1"]])])) for r in found}
    frame = _range_index(frame, "_k1", bounds, "_r1") if bounds else frame.withColumn("_r1", F.lit(0.0))
    if heavy:
        # A heavy value v opens range [v, next): rows equal to v come first, cut by _k2; the rest follow.
        # The table has at most one row per range.
        table = df.sparkSession.createDataFrame(list(heavy.items()), "_k1 double, _cut array<double>")
        frame = frame.join(F.broadcast(table), "_k1", "left")
        place = F.size(F.filter("_cut", lambda b: b <= F.col("_k2")))
        frame = frame.withColumn("_r2", F.when(F.col("_cut").isNotNull(), place).otherwise(ranges + 1)).drop("_cut")
    else:
        frame = frame.withColumn("_r2", F.lit(0))
    for name, expr in sums.items():
        frame = frame.withColumn(f"_v_{name}", as_column(expr))
    part = [*within, "_r1", "_r2"]
    totals = frame.groupBy(*part).agg(*[F.sum(f"_v_{s}").alias(f"_t_{s}") for s in sums])
    # At most a few thousand range rows per group: offsets are a window over this summary.
    before = Window.partitionBy(*within).orderBy("_r1", "_r2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums])
    local = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_left(frame, offsets, part)
    out = joined.withColumns(
        {s: F.sum(f"_v_{s}").over(local) + F.coalesce(F.col(f"_o_{s}"), F.lit(0)) for s in sums}
    )
    scratch = ["_k1", "_k2", "_r1", "_r2", *[f"_v_{s}" for s in sums], *[f"_o_{s}" for s in sums]]
    return out.drop(*scratch)


def global_rank(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "rank", within: Sequence[str] = (), **options
) -> DataFrame:
    """1-based row number over the whole table (or per group), without a single-task window."""
    return running_totals(df, order_by, {name: F.lit(1)}, within, **options)

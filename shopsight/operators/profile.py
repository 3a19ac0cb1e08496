"""Data profiles. Each is a few aggregations over the whole table, reshaped to long form afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shopsight.functions.values import finite
from shopsight.operators.ranking import quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def basic_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated rows, missing values: one row.

    Rows are combined with their equals first; everything else is counted from the distinct rows.
    """
    width = len(df.columns)
    nulls = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    grouped = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    counted = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.lit(width).alias("columns"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("duplicates"),
        F.coalesce(F.sum(nulls * F.col("_n")), F.lit(0)).alias("total_missing"),
    )
    share = F.try_divide(F.col("total_missing"), F.col("rows") * F.col("columns"))
    return counted.withColumn("missing_pct", F.round(share * 100, 2))


def _exploded(df: DataFrame, structs: dict[str, dict[str, Column]], key: str = "column") -> DataFrame:
    """One aggregation of every (name, metric), then one row per name."""
    names = list(structs)
    metrics = list(structs[names[0]])
    aggs = [structs[n][m].alias(f"{i}_{j}") for i, n in enumerate(names) for j, m in enumerate(metrics)]
    wide = df.agg(*aggs)
    items = [
        F.struct(F.lit(n).alias(key), *[F.col(f"{i}_{j}").alias(m) for j, m in enumerate(metrics)])
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*items)))


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, null count and share, distinct values and a sample value (the smallest) per column.

    Exact distinct counts combine (column, value) pairs before counting; `approx` avoids that shuffle.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    facts = {
        c: {
            "dtype": F.lit(kinds[c]),
            "rows": F.count("*"),
            "non_null": F.count(c),
            "sample": F.min(c).cast("string"),
            **({"unique": F.approx_count_distinct(c)} if approx else {}),
        }
        for c in df.columns
    }
    base = _exploded(df, facts)
    if not approx:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        pairs = texts.unpivot([], df.columns, "column", "value").where(F.col("value").isNotNull())
        counts = pairs.distinct().groupBy("column").agg(F.count("*").alias("unique"))
        base = base.join(counts, "column", "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
    null_count = F.col("rows") - F.col("non_null")
    return base.select(
        "column",
        "dtype",
        "non_null",
        null_count.alias("null_count"),
        F.round(F.try_divide(null_count, F.col("rows")) * 100, 2).alias("null_pct"),
        "unique",
        "sample",
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Missing counts with a suggested treatment, most missing first."""

    def treatment(kind: T.DataType) -> str:
        if isinstance(kind, T.StringType):
            return "mode_or_unknown"
        if isinstance(kind, T.NumericType):
            return "median"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "keep_null"
        return "investigate"

    fields = df.schema.fields
    facts = {
        f.name: {
            "missing_count": F.count("*") - F.count(f.name),
            "rows": F.count("*"),
            "dtype": F.lit(f.dataType.simpleString()),
            "by_type": F.lit(treatment(f.dataType)),
        }
        for f in fields
    }
    pct = F.round(F.try_divide(F.col("missing_count"), F.col("rows")) * 100, 2)
    table = _exploded(df, facts).withColumn("missing_pct", F.coalesce(pct, F.lit(0.0)))
    advice = (
        F.when(F.col("missing_pct") == 0, "none").when(F.col("missing_pct") > 50, "drop_column").otherwise(F.col("by_type"))
    )
    return table.select(
        "column", "missing_count", "missing_pct", "dtype", advice.alias("suggested_strategy")
    ).orderBy(F.col("missing_pct").desc(), "column")


def class_balance(df: DataFrame, target: str = "is_satisfied") -> DataFrame:
    """One row: sizes, majority and minority class (lowest on ties), their ratio, imbalanced above 3."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    ratio = F.max("n") / F.min("n")
    return counts.agg(
        F.sum("n").alias("total_samples"),
        F.min_by(target, F.struct(-F.col("n"), F.col(target))).alias("majority_class"),
        F.min_by(target, F.struct(F.col("n"), F.col(target))).alias("minority_class"),
        F.round(ratio, 2).alias("imbalance_ratio"),
        (ratio > 3).alias("is_imbalanced"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of every known value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.join(total).select(column, "n", F.round(F.col("n") / F.col("_all") * 100, 2).alias("pct"))


def corrected_skewness(x: Column) -> Column:
    """Bias-corrected sample skewness; null under three values."""
    n, g = F.count(x), F.skewness(x)
    return F.when(n > 2, g * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(x: Column) -> Column:
    """Bias-corrected sample excess kurtosis; null under four values."""
    n, g = F.count(x), F.kurtosis(x)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))


def _two_digits(value: float | None) -> Column:
    """A fitted number at two digits, rounded as hundredths."""
    return F.round(F.lit(value).cast("double") * 100) / 100


def regression_target(df: DataFrame, target: str = "delivery_days") -> DataFrame:
    """Distribution of a numeric target: moments, quartile bounds, outliers, whether to transform it."""
    clean = df.select(F.col(target).alias("raw"), finite(target).alias("x"))
    q1, median, q3 = quantiles(clean, ["x"], [0.25, 0.5, 0.75])["x"] or (None, None, None)
    low = None if q1 is None else q1 - 1.5 * (q3 - q1)
    high = None if q1 is None else q3 + 1.5 * (q3 - q1)
    x = F.col("x")
    row = clean.agg(
        F.count("x").alias("total_samples"),
        F.count_if(F.col("raw").isNull() | F.isnan(F.col("raw").cast("double"))).alias("null_count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        corrected_skewness(x).alias("skewness"),
        corrected_kurtosis(x).alias("kurtosis"),
        F.count_if((x < F.lit(low)) | (x > F.lit(high))).alias("outliers_count"),
    )
    round2 = {c: F.round(c, 2) for c in ("mean", "std", "min", "max", "skewness", "kurtosis")}
    share = F.try_divide(F.col("outliers_count"), F.col("total_samples"))
    return row.withColumns(
        {
            "needs_transform": F.abs("skewness") > 1,
            "outliers_pct": F.round(share * 100, 2),
            "median": _two_digits(median),
            "iqr_lower": _two_digits(low),
            "iqr_upper": _two_digits(high),
        }
    ).withColumns(round2)


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5) -> DataFrame:
    """Values outside the quartiles by more than `multiplier` spreads, per column, largest share first."""
    columns = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    # Read for the quartiles and again for the counts; the columns stay persisted with the result.
    df = df.select(*columns).persist()
    fitted = {c: q for c, q in quantiles(df, columns, [0.25, 0.75], keep=False).items() if q}
    facts = {}
    for c, (q1, q3) in fitted.items():
        spread = q3 - q1
        low, high = q1 - multiplier * spread, q3 + multiplier * spread
        facts[c] = {
            "Q1": _two_digits(q1),
            "Q3": _two_digits(q3),
            "IQR": _two_digits(spread),
            "lower_bound": _two_digits(low),
            "upper_bound": _two_digits(high),
            "outliers_low": F.count_if(F.col(c) < low),
            "outliers_high": F.count_if(F.col(c) > high),
            "values": F.count(c),
        }
    total = F.col("outliers_low") + F.col("outliers_high")
    return (
        _exploded(df, facts)
        .withColumn("outliers_total", total)
        .withColumn("outliers_pct", F.round(total / F.col("values") * 100, 2))
        .drop("values")
        .orderBy(F.col("outliers_pct").desc(), "column")
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, per_pass: int = 200) -> DataFrame:
    """Pearson correlation of every pair i < j over the rows where both are known.

    One aggregation takes up to `per_pass` pairs; more columns take more passes, not a larger one.
    """
    columns = list(columns or numeric_columns(df))
    clean = df.select(*[finite(c).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, correlation double")
    out = None
    for start in range(0, len(pairs), per_pass):
        chunk = pairs[start : start + per_pass]
        wide = clean.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(chunk)])
        items = [
            F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), F.col(f"r{i}").alias("correlation"))
            for i, (a, b) in enumerate(chunk)
        ]
        rows = wide.select(F.inline(F.array(*items)))
        out = rows if out is None else out.unionByName(rows)
    return out


def high_correlations(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.7) -> DataFrame:
    pairs = correlation_pairs(df, columns).where(F.abs("correlation") >= threshold)
    return pairs.withColumn("correlation", F.round("correlation", 3)).orderBy(F.abs("correlation").desc())


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every other numeric column with the target, strongest first."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    clean = df.select(*[finite(c).alias(c) for c in [*columns, target]])
    facts = {c: {"correlation": F.corr(c, target)} for c in columns}
    return _exploded(clean, facts, "feature").orderBy(F.abs("correlation").desc_nulls_last(), "feature")


def temporal_range(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    span = F.floor((F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(86_400_000_000))
    return df.agg(
        F.date_format(F.min(ts), "yyyy-MM-dd").alias("start"),
        F.date_format(F.max(ts), "yyyy-MM-dd").alias("end"),
        span.cast("long").alias("span_days"),
    )


def temporal_counts(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Rows by weekday (Monday 0), month and hour. Rows are combined over the three parts first."""
    parts = df.where(F.col(ts).isNotNull()).select(
        F.weekday(ts).alias("dayofweek"), F.month(ts).alias("month"), F.hour(ts).alias("hour")
    )
    cells = parts.groupBy("dayofweek", "month", "hour").agg(F.count("*").alias("n"))
    long = cells.unpivot(["n"], ["dayofweek", "month", "hour"], "part", "value")
    return long.groupBy("part", "value").agg(F.sum("n").alias("orders"))


def categorical_profile(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """The most frequent values with counts and shares, and the number of distinct and null values."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    known = F.col(column).isNotNull()
    totals = counts.agg(
        F.count_if(known).alias("unique_values"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.sum(F.when(known, F.col("n"))).alias("_all"),
    )
    best = counts.where(known).orderBy(F.col("n").desc(), column).limit(top)
    return best.join(totals).select(
        F.col(column).alias("value"),
        "n",
        F.round(F.col("n") / F.col("_all") * 100, 2).alias("pct"),
        "unique_values",
        "null_count",
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes, quartiles and skewness per numeric column."""
    columns = list(columns or numeric_columns(df))
    facts = {
        c: {
            "count": F.count(c),
            "mean": F.avg(c),
            "std": F.stddev_samp(c),
            "min": F.min(F.col(c).cast("double")),
            "max": F.max(F.col(c).cast("double")),
            "skewness": corrected_skewness(F.col(c)),
        }
        for c in columns
    }
    fitted = quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [(c, *(q or (None, None, None))) for c, q in fitted.items()]
    quarters = df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return _exploded(df, facts).join(quarters, "column")


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed: bin, left edge, count, density."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, left_edge double, n long, density double")
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    x = F.col(column)
    index = F.least(F.lit(bins - 1), F.floor((x - low) / width).cast("int"))
    counted = df.where(x.isNotNull()).groupBy(*by, index.alias("bin")).agg(F.count("*").alias("n"))
    if by:  # one row for each group and bin; rows without a group are a group
        joined = counted.withColumn("_all", F.sum("n").over(Window.partitionBy(*by)))
    else:
        joined = counted.join(counted.agg(F.sum("n").alias("_all")))
    return joined.select(
        *by,
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("left_edge"),
        "n",
        (F.col("n") / (F.col("_all") * width)).alias("density"),
    )

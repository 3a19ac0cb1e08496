"""Customer, category, seller and time aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopsight.functions.values import MICROS_PER_DAY
from shopsight.operators.ranking import medians, quantile_table


def reference_micros(df: DataFrame, reference: datetime | str | None, ts: str) -> int:
    """The date recency counts from: the one given, else the latest timestamp."""
    if reference is None:
        return df.agg(F.unix_micros(F.max(ts))).first()[0]
    stamp = reference if isinstance(reference, str) else reference.isoformat(sep=" ")
    return df.sparkSession.range(1).select(F.unix_micros(F.lit(stamp).cast("timestamp"))).first()[0]


def _recency(reference: int, ts: str) -> Column:
    return F.floor((F.lit(reference) - F.unix_micros(F.max(ts))) / F.lit(MICROS_PER_DAY)).cast("long")


def once_per(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keep the value on the first row of each key and blank it on the repeats."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(value, F.when(F.row_number().over(w) == 1, F.col(value)))


def rfm(
    df: DataFrame,
    reference: datetime | str | None = None,
    dedup_by: str | None = None,
    customer: str = "customer_unique_id",
    order: str = "order_id",
    ts: str = "order_purchase_timestamp",
    value: str = "payment_value",
) -> DataFrame:
    """Recency in completed days, number of orders, total spend, and two ratios, per customer.

    The spend adds the value of every row. An order repeated over its items counts once per item unless
    `dedup_by` names the column within which it should count once.
    """
    at = reference_micros(df, reference, ts)
    if dedup_by:
        df = once_per(df, [customer, dedup_by], value)
    table = (
        df.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            _recency(at, ts).alias("recency"),
            F.count_distinct(order).alias("frequency"),
            F.coalesce(F.sum(value), F.lit(0.0)).alias("monetary"),
        )
    )
    return table.withColumns(rfm_ratios())


def rfm_ratios() -> dict[str, Column]:
    return {
        "avg_order_value": F.try_divide(F.col("monetary"), F.col("frequency")),
        "monetary_per_day": F.col("monetary") / (F.col("recency") + 1),
    }


def customer_behaviour(
    df: DataFrame,
    reference: datetime | str | None = None,
    dedup_by: str | None = None,
    fills: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """RFM plus review, delivery, price and category behaviour, per customer.

    A customer without a review or delivery gets the median over customers (or the value in `fills`).
    Orders are counted by the first row of each, in a window that the partitioning of the merged frame serves: a
    distinct count beside the mode would keep and sort a table of categories for every order, twice.
    """
    ts = "order_purchase_timestamp"
    at = reference_micros(df, reference, ts)
    if dedup_by:
        df = once_per(df, ["customer_unique_id", dedup_by], "payment_value")
    rows_of_order = Window.partitionBy("order_id", "customer_unique_id").orderBy(F.lit(0))
    first = F.col("order_id").isNotNull() & (F.row_number().over(rows_of_order) == 1)
    table = (
        df.where(F.col("customer_unique_id").isNotNull())
        .withColumn("_first", first)
        .groupBy("customer_unique_id")
        .agg(
            _recency(at, ts).alias("recency"),
            F.count_if("_first").alias("frequency"),
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("monetary"),
            F.avg("review_score").alias("avg_review_score"),
            F.avg("delivery_days").alias("avg_delivery_days"),
            F.avg("is_late_delivery").alias("late_delivery_rate"),
            F.avg("price").alias("avg_price"),
            F.count("order_item_id").alias("total_items"),
            F.coalesce(F.mode("product_category_name_english", True), F.lit("unknown")).alias("favorite_category"),
        )
    )
    filled = ["avg_review_score", "avg_delivery_days"]
    if fills is None:
        # The table is read for the medians and again for the result; it stays persisted with the result.
        table = table.persist()
        fills = medians(table, filled, keep=False)
    ready = {c: F.coalesce(F.col(c), F.lit(fills[c])) for c in filled if fills.get(c) is not None}
    return table.withColumns({**ready, **rfm_ratios()})


def category_price_stats(df: DataFrame, category: str = "product_category_name_english") -> DataFrame:
    """Mean and sample deviation of the price per category; a lone product has deviation 1."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(
            F.avg("price").alias("category_price_mean"),
            F.coalesce(F.stddev_samp("price"), F.lit(1.0)).alias("category_price_std"),
        )
    )


def cluster_profile(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Mean, median and sample deviation per cluster and feature, long form, two decimals."""
    moments = df.groupBy(cluster).agg(
        *[F.struct(F.avg(f).alias("mean"), F.stddev_samp(f).alias("std")).alias(f) for f in features]
    )
    stats = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}.mean"), F.col(f"{f}.std")) for f in features])
    )
    moments = moments.select(cluster, stats.alias("s")).select(cluster, "s.feature", "s.mean", "s.std")
    middle = quantile_table(df, features, [0.5], by=[cluster]).select(
        cluster, F.col("column").alias("feature"), F.col("q")[0].alias("median")
    )
    return moments.join(middle, [cluster, "feature"]).select(
        cluster, "feature", *[F.round(c, 2).alias(c) for c in ("mean", "median", "std")]
    )


def cluster_summary(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Mean features, size and share (percent) of every cluster: one row each."""
    table = df.groupBy(cluster).agg(
        *[F.round(F.avg(f), 2).alias(f) for f in features], F.count("*").alias("count")
    )
    everyone = table.agg(F.sum("count").alias("_all"))
    share = F.round(F.col("count") / F.col("_all") * 100, 1).alias("pct")
    return table.join(everyone).select(cluster, *features, "count", share)


def monthly_counts(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    month = F.date_format(F.date_trunc("month", ts), "yyyy-MM").alias("month")
    return df.where(F.col(ts).isNotNull()).groupBy(month).agg(F.count("*").alias("orders"))


def mean_by(df: DataFrame, group: str, metrics: Sequence[str]) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*[F.avg(m).alias(m) for m in metrics])


def revenue_by(df: DataFrame, group: str = "customer_state", value: str = "payment_value") -> DataFrame:
    kept = df.where(F.col(group).isNotNull())
    return kept.groupBy(group).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("revenue"))


def seller_history(
    df: DataFrame, seller: str = "seller_id", ts: str = "order_purchase_timestamp", score: str = "review_score"
) -> DataFrame:
    """Per row: the seller's mean score over strictly earlier instants; null without history.

    Scores are combined per (seller, instant), so equal instants never see each other. Earlier days come
    from a window over one row per seller and day, earlier instants of the same day from a window inside
    that day: a seller with a third of all rows still spreads over its days.
    """
    instant, day = F.unix_micros(ts), F.to_date(ts)
    moments = df.groupBy(seller, day.alias("_day"), instant.alias("_at")).agg(
        F.sum(score).alias("_sum"), F.count(score).alias("_n")
    )
    days = moments.groupBy(seller, "_day").agg(F.sum("_sum").alias("_dsum"), F.sum("_n").alias("_dn"))
    past_days = Window.partitionBy(seller).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(
        seller, "_day", F.sum("_dsum").over(past_days).alias("_dsum"), F.sum("_dn").over(past_days).alias("_dn")
    )
    same_day = Window.partitionBy(seller, "_day").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    moments = moments.withColumns({"_psum": F.sum("_sum").over(same_day), "_pn": F.sum("_n").over(same_day)})
    total = F.coalesce("_psum", zero) + F.coalesce("_dsum", zero)
    rows = F.coalesce("_pn", zero) + F.coalesce("_dn", zero)
    past = moments.join(days, [seller, "_day"]).select(
        seller, "_at", F.try_divide(total, rows).alias("seller_historical_rating")
    )
    return df.withColumn("_at", instant).join(past, [seller, "_at"], "left").drop("_at")


def customer_tenure(
    df: DataFrame, customer: str = "customer_unique_id", ts: str = "order_purchase_timestamp"
) -> DataFrame:
    """Days since the customer's first order, and days promised until delivery."""
    first = df.groupBy(customer).agg(F.unix_micros(F.min(ts)).alias("_first"))
    since = (F.unix_micros(ts) - F.col("_first")) / F.lit(float(MICROS_PER_DAY))
    promised = (F.unix_micros("order_estimated_delivery_date") - F.unix_micros(ts)) / F.lit(float(MICROS_PER_DAY))
    return (
        df.join(first, customer, "left")
        .withColumn("days_since_first_order", F.floor(since).cast("long"))
        .withColumn("days_promised", promised)
        .drop("_first")
    )

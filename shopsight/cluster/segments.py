"""Names for clusters, tests between clusters, scoring of new customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, Window, functions as F

NEUTRAL = 0.5


def _relative(summary: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Attach the extremes of each feature; return expressions scaled to [0, 1]."""
    present = [c for c in names if c in summary.columns]
    ends = summary.agg(
        *[F.min(c).alias(f"_l_{c}") for c in present], *[F.max(c).alias(f"_h_{c}") for c in present]
    )
    wide = summary.join(ends) if present else summary
    scaled = {
        c: F.when(
            F.col(f"_h_{c}") > F.col(f"_l_{c}"),
            (F.col(c) - F.col(f"_l_{c}")) / (F.col(f"_h_{c}") - F.col(f"_l_{c}")),
        ).otherwise(F.col(c))
        for c in present
    }
    return wide, scaled


def business_labels(
    summary: DataFrame,
    cluster: str = "cluster_id",
    recency: str = "recency",
    frequency: str = "frequency_log",
    monetary: str = "monetary_log",
    review: str = "avg_review_score",
    output: str = "customer_segment",
) -> DataFrame:
    """(cluster, name): names from relative recency, frequency, spend and review of the cluster means.

    A feature the summary lacks counts as 0.5. A name given before gets the cluster number appended.
    """
    wide, scaled = _relative(summary, [recency, frequency, monetary, review])
    r, f, m, s = (scaled.get(c, F.lit(NEUTRAL)) for c in (recency, frequency, monetary, review))
    # The thresholds of the names.
    active = (r < 0.4) & ((m > 0.5) | (f > 0.5))
    base = (
        F.when(active & (s > 0.5), "champions")
        .when(active, "needs_attention")
        .when(r > 0.6, "at_risk")
        .when(m > 0.6, "big_spenders")
        .otherwise("potential_loyalists")
    )
    named = wide.select(cluster, base.alias("_base"))
    again = F.row_number().over(Window.partitionBy("_base").orderBy(cluster)) > 1
    name = F.when(again, F.concat_ws("_", "_base", F.col(cluster).cast("string"))).otherwise(F.col("_base"))
    return named.select(cluster, name.alias(output))


def score_customers(customers: DataFrame, prep: PipelineModel, model) -> DataFrame:
    """Cluster of customers not seen in training, through the fitted preparation and model."""
    return model.transform(prep.transform(customers)).withColumnRenamed("prediction", "cluster_id")


def anova_f(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """One-way F statistic of each feature between clusters, from group sums."""
    out = None
    groups = df.groupBy(cluster).agg(
        *[F.count(c).alias(f"{c}_n") for c in features],
        *[F.avg(c).alias(f"{c}_m") for c in features],
        *[F.var_pop(c).alias(f"{c}_v") for c in features],
    )
    for c in features:
        n, m, v = F.col(f"{c}_n"), F.col(f"{c}_m"), F.col(f"{c}_v")
        total, k = F.sum(n), F.count_if(n > 0)
        between = F.sum(n * m * m) - F.pow(F.sum(n * m), 2) / total
        within = F.sum(n * v)
        row = groups.agg(
            F.try_divide(between / F.nullif(k - 1, F.lit(0)), within / F.nullif(total - k, F.lit(0))).alias("f_statistic"),
            (k - 1).alias("df_between"),
            (total - k).alias("df_within"),
        ).select(F.lit(c).alias("feature"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def chi_square(df: DataFrame, cluster: str, column: str) -> DataFrame:
    """Independence of a category and the cluster: statistic, degrees of freedom, p value."""
    indexed = StringIndexer(inputCol=column, outputCol="_i", stringOrderType="alphabetAsc").fit(df).transform(df)
    ready = VectorAssembler(inputCols=["_i"], outputCol="_v").transform(indexed)
    return ChiSquareTest.test(ready, "_v", cluster, flatten=True).select(
        F.lit(column).alias("feature"), "statistic", "degreesOfFreedom", "pValue"
    )

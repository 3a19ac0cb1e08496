"""Feature attribution and importance, as jobs over changed copies of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopsight.learn.models import scored
from shopsight.operators.ranking import global_rank


def sample_rows(df: DataFrame, id_column: str, share: float = 1.0, seed: int = 42) -> DataFrame:
    """All rows, or the asked share of them by a hash of the id; no row count decides."""
    if share >= 1:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))


def mean_background(df: DataFrame, features: str = "features") -> list[float]:
    size = df.first()[features].size
    x = df.select(vector_to_array(features).alias("x"))
    return list(x.agg(*[F.avg(F.col("x")[i]).alias(str(i)) for i in range(size)]).first())


def shapley_values(
    model,
    rows: DataFrame,
    id_column: str,
    background: Sequence[float],
    permutations: int = 10,
    features: str = "features",
    seed: int = 42,
) -> DataFrame:
    """(id, feature, contribution) averaged over random feature orders.

    Along each order the features of the background are replaced one by one by those of the row, and the
    change of the score goes to the feature replaced: per row the contributions add up to the score minus
    the background score.
    """
    d = len(background)
    base = F.array(*[F.lit(float(v)) for v in background])
    keyed = F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.struct(F.xxhash64(F.col(id_column).cast("string"), F.col("_p"), i, F.lit(seed)).alias("h"), i.alias("i")),
    )
    orders = (
        rows.select(id_column, vector_to_array(features).alias("_x"))
        .withColumn("_p", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_order", F.transform(F.array_sort(keyed), lambda s: s["i"]))
        .withColumn("_place", F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.array_position("_order", i)))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    mixed = F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.when(F.get("_place", i) <= F.col("_step"), F.get("_x", i)).otherwise(F.get(base, i)),
    )
    chain = orders.withColumn(features, array_to_vector(mixed))
    steps = scored(model, chain).select(id_column, "_p", "_step", "_order", "score")
    walk = Window.partitionBy(id_column, "_p").orderBy("_step")
    change = steps.withColumn("_change", F.col("score") - F.lag("score").over(walk)).where(F.col("_step") > 0)
    feature = F.get("_order", F.col("_step") - 1)
    return change.groupBy(id_column, feature.alias("feature")).agg(
        (F.sum("_change") / permutations).alias("contribution")
    )


def attribution_summary(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean absolute contribution by feature name, largest first."""
    means = values.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    return named(means, names).orderBy(F.col("importance").desc(), "feature")


def named(table: DataFrame, names: Sequence[str], position: str = "feature") -> DataFrame:
    """Replace vector positions by names."""
    labels = F.array(*[F.lit(n) for n in names])
    return table.withColumn(position, F.get(labels, F.col(position).cast("int")))


def tree_importances(model, names: Sequence[str], spark) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def linear_attributions(
    coefficients: Sequence[float], rows: DataFrame, id_column: str, background: Sequence[float], features: str = "features"
) -> DataFrame:
    """Exact contributions of a linear score: coefficient x (value - background)."""
    x = vector_to_array(features)
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(len(background) - 1)),
        lambda i: F.get(F.array(*[F.lit(float(c)) for c in coefficients]), i)
        * (F.get(x, i) - F.get(F.array(*[F.lit(float(b)) for b in background]), i)),
    )
    return rows.select(id_column, F.posexplode(parts).alias("feature", "contribution"))


def permutation_importance(
    model,
    df: DataFrame,
    id_column: str,
    label: str = "label",
    features: str = "features",
    kind: str = "classifier",
    seed: int = 42,
) -> DataFrame:
    """Loss of quality per feature when its values are moved to other rows.

    Rows are ranked by a hash, and every row takes the value of the next rank: one join gives the
    partner for all features, and each feature is then scored on its own changed copy.
    """
    base = df.select(id_column, label, features)
    ranked = global_rank(base.withColumn("_h", F.xxhash64(F.col(id_column).cast("string"), F.lit(seed))), ["_h"], "_r")
    n = base.count()
    next_rank = F.when(F.col("_r") == 1, n).otherwise(F.col("_r") - 1)
    partner = ranked.select(next_rank.alias("_r"), vector_to_array(features).alias("_y"))
    d = base.first()[features].size
    both = ranked.join(partner, "_r").withColumn("_x", vector_to_array(features)).drop(features)
    copies = both.withColumn("feature", F.explode(F.sequence(F.lit(-1), F.lit(d - 1))))
    swapped = F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.when(i == F.col("feature"), F.get("_y", i)).otherwise(F.get("_x", i)),
    )
    results = scored(model, copies.withColumn(features, array_to_vector(swapped)))
    quality = _quality(kind, label)
    by_feature = results.groupBy("feature").agg(quality.alias("quality"))
    baseline = by_feature.where("feature = -1").select(F.col("quality").alias("_base"))
    return by_feature.where("feature >= 0").join(baseline).select(
        "feature", (F.col("_base") - F.col("quality")).alias("importance")
    )


def _quality(kind: str, label: str) -> Column:
    """Accuracy for a classifier, negative root mean squared error for a regressor."""
    if kind == "classifier":
        return F.avg((F.col("prediction") == F.col(label)).cast("double"))
    gap = F.col("prediction") - F.col(label)
    return -F.sqrt(F.avg(gap * gap))

"""Quality of a labelling. Label -1 is noise and takes no part."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from shopsight.cluster.blocks import (
    BLOCK_ROWS,
    all_pairs,
    as_points,
    distances,
    every_pair,
    make_blocks,
    make_stripes,
    on_pairs,
    paired,
    product_distances,
)
from shopsight.session import together

# The closed form over squared distances, whatever the number of rows; 'exact' needs work that grows with its square.
MEASURES = ("squared", "exact")
REPORT = (
    "name string, n_clusters long, n_noise long, silhouette double, davies_bouldin double, "
    "calinski_harabasz double, error string, measure string"
)


def as_vectors(df: DataFrame, features: str) -> DataFrame:
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return df.withColumn(features, array_to_vector(F.col(features).cast("array<double>")))
    return df


def _label_sums(xs_a, labels_a, n_a: int, xs_b, labels_b, n_b: int, same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each point of a, then of b (unless they are the same): the labels of the other block and the distances summed over each.

    Copies within a block are measured once.
    """

    def places(xs, n: int, labels) -> tuple:
        rows = np.ascontiguousarray(np.asarray(xs, float).reshape(n, -1)) + 0.0
        whole = rows.view([("", rows.dtype)] * rows.shape[1]).ravel() if rows.shape[1] > 1 else rows.ravel()
        _, first, back = np.unique(whole.view(f"V{rows.shape[1] * 8}"), return_index=True, return_inverse=True)
        names, label = np.unique(np.asarray(labels), return_inverse=True)
        times = np.zeros((len(first), len(names)))
        np.add.at(times, (back, label), 1.0)
        return rows[first], back, names, times

    a, back_a, names_a, times_a = places(xs_a, n_a, labels_a)
    b, back_b, names_b, times_b = (a, back_a, names_a, times_a) if same else places(xs_b, n_b, labels_b)
    sums_a, sums_b = np.zeros((len(a), len(names_b))), np.zeros((len(b), len(names_a)))
    for i in range(0, len(a), BLOCK_ROWS):
        for j in range(0, len(b), BLOCK_ROWS):
            gaps = product_distances(a[i : i + BLOCK_ROWS], b[j : j + BLOCK_ROWS])
            sums_a[i : i + BLOCK_ROWS] += gaps @ times_b[j : j + BLOCK_ROWS]
            if not same:
                sums_b[j : j + BLOCK_ROWS] += gaps.T @ times_a[i : i + BLOCK_ROWS]
    return [(names_b, sums_a[back_a])] + ([] if same else [(names_a, sums_b[back_b])])


def silhouette_samples(
    df: DataFrame,
    id_column: str,
    label: str = "cluster",
    features: str = "features",
    block_rows: int | None = None,
) -> DataFrame:
    """Exact Euclidean silhouette of every row: id, label, a, b, silhouette.

    Every pair of blocks is measured once and returns, per point of both, the sum of distances to each label of the
    other; pairs of points are not emitted.
    """
    points = as_points(df, id_column, features, [F.col(label).cast("long").alias("label")])
    blocks = make_stripes(points, block_rows)

    def add(row) -> pd.DataFrame:
        found = _label_sums(row.xs_a, row.labels_a, row.n_a, row.xs_b, row.labels_b, row.n_b, row.a == row.b)
        parts = [
            pd.DataFrame(
                {
                    "id": np.repeat(np.asarray(ids), len(names)),
                    "label": np.repeat(np.asarray(labels), len(names)),
                    "other": np.tile(names, len(ids)),
                    "total": sums.ravel(),
                }
            )
            for (names, sums), ids, labels in zip(found, (row.ids_a, row.ids_b), (row.labels_a, row.labels_b))
        ]
        return pd.concat(parts)

    sums = on_pairs(every_pair(blocks, ["ids", "xs", "labels", "n"]), add, "id long, label long, other long, total double")
    sums = sums.groupBy("id", "label", "other").agg(F.sum("total").alias("total"))
    sizes = points.groupBy(F.col("label").alias("other")).agg(F.count("*").alias("size"))
    own = F.col("label") == F.col("other")
    per_point = (
        sums.join(sizes, "other")
        .groupBy("id", "label")
        .agg(
            F.max(F.when(own, F.col("size"))).alias("size"),
            F.max(F.when(own, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
        )
    )
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return per_point.select(
        F.col("id").alias(id_column),
        F.col("label").alias(label),
        "a",
        "b",
        F.when(F.col("size") > 1, score).otherwise(0.0).alias("silhouette"),
    )


def exact_silhouette(df: DataFrame, id_column: str, label: str = "cluster", features: str = "features") -> float:
    return silhouette_samples(df, id_column, label, features).agg(F.avg("silhouette")).first()[0]


def squared_silhouette(df: DataFrame, label: str = "cluster", features: str = "features") -> float:
    """Silhouette over squared distances, from cluster sums in two passes."""
    ready = as_vectors(df, features).withColumn("_label", F.col(label).cast("double"))
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol="_label")
    return evaluator.evaluate(ready.select(features, "_label"))


def centroid_table(df: DataFrame, label: str = "cluster", features: str = "features") -> DataFrame:
    """label, size, centroid (array), scatter (mean distance to it), squares (sum of squared distances)."""
    ready = as_vectors(df, features).select(F.col(label).cast("long").alias("label"), F.col(features).alias("v"))
    means = ready.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    means = means.select("label", vector_to_array("m").alias("centroid"))
    gaps = F.zip_with(vector_to_array("v"), F.col("centroid"), lambda a, b: (a - b) * (a - b))
    square = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g)
    spread = ready.join(means, "label").withColumn("_d2", square)
    stats = spread.groupBy("label").agg(
        F.count("*").alias("size"), F.avg(F.sqrt("_d2")).alias("scatter"), F.sum("_d2").alias("squares")
    )
    return stats.join(means, "label")


def davies_bouldin(centroids: DataFrame) -> float:
    """Mean over clusters of the worst (scatter + scatter) / distance; coinciding centroids count 0."""
    points = centroids.select(F.col("label").alias("id"), F.col("centroid").alias("x"), F.col("scatter").alias("s"))
    blocks = make_blocks(points)

    def worst(row) -> pd.DataFrame:
        gaps = distances(row.xs_a, row.n_a, row.xs_b, row.n_b)
        ids_a, ids_b = np.asarray(row.ids_a), np.asarray(row.ids_b)
        both = np.add.outer(np.asarray(row.ss_a, float), np.asarray(row.ss_b, float))
        ratio = np.divide(both, gaps, out=np.zeros_like(gaps), where=gaps > 0)
        ratio[np.equal.outer(ids_a, ids_b)] = 0.0
        return pd.DataFrame({"id": ids_a, "ratio": ratio.max(axis=1)})

    rows = paired(blocks, all_pairs(blocks), ["ids", "xs", "ss", "n"])
    best = on_pairs(rows, worst, "id long, ratio double").groupBy("id").agg(F.max("ratio").alias("ratio"))
    value = best.agg(F.avg("ratio")).first()[0]
    blocks.release()
    return value


def calinski_harabasz(centroids: DataFrame) -> float | None:
    """Between-cluster over within-cluster dispersion, each per degree of freedom."""
    weighted = centroids.select("size", "squares", F.posexplode("centroid").alias("axis", "c"))
    axis = weighted.groupBy("axis").agg(
        F.sum(F.col("size") * F.col("c")).alias("s"),
        F.sum(F.col("size") * F.col("c") * F.col("c")).alias("q"),
        F.sum("size").alias("n"),
    )
    between = axis.agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n"))).first()[0]
    row = centroids.agg(F.sum("squares"), F.sum("size"), F.count("*")).first()
    within, n, k = row
    if within == 0:
        return 1.0
    return between * (n - k) / (within * (k - 1)) if k > 1 and n > k else None


def evaluate_labels(
    df: DataFrame,
    name: str,
    id_column: str,
    label: str = "cluster",
    features: str = "features",
    silhouette: str = "squared",
) -> DataFrame:
    """One row of quality measures; `silhouette` is one of MEASURES and stands in the column measure."""
    if silhouette not in MEASURES:
        raise ValueError(f"silhouette is one of {MEASURES}")
    spark = df.sparkSession
    kept = df.where(F.col(label) != -1)
    row = df.agg(
        F.count_distinct(F.when(F.col(label) != -1, F.col(label))).alias("k"),
        F.count_if(F.col(label) == -1).alias("noise"),
    ).first()
    if row["k"] < 2:
        return spark.createDataFrame(
            [(name, row["k"], row["noise"], None, None, None, "Less than 2 clusters", silhouette)], REPORT
        )
    if silhouette == "exact":
        score = exact_silhouette(kept, id_column, label, features)
    else:
        score = squared_silhouette(kept, label, features)
    centroids = centroid_table(kept, label, features).persist()
    out = (
        name,
        row["k"],
        row["noise"],
        score,
        davies_bouldin(centroids),
        calinski_harabasz(centroids),
        None,
        silhouette,
    )
    centroids.unpersist()
    return spark.createDataFrame([out], REPORT)


def compare_methods(
    df: DataFrame,
    labels: Mapping[str, str],
    id_column: str,
    features: str = "features",
    silhouette: str = "squared",
    threads: int = 4,
) -> DataFrame:
    """Quality of several label columns of one frame, one row per method, evaluated as concurrent jobs."""

    def once(item: tuple[str, str]) -> DataFrame:
        return evaluate_labels(df, item[0], id_column, item[1], features, silhouette)

    rows = together(df.sparkSession, once, labels.items(), threads)
    return reduce(DataFrame.unionByName, rows)

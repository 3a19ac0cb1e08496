"""Customer segmentation: preparation, four methods, comparison, names. Also a spark-submit job."""

from __future__ import annotations

import argparse
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from shopsight.cluster.density import dbscan, k_distances, suggest_eps
from shopsight.cluster.kmeans import CentreModel, fit_many
from shopsight.cluster.metrics import compare_methods
from shopsight.cluster.models import best_k, fit_mixtures, gmm_labels, hierarchical, sweep_gmm, sweep_kmeans
from shopsight.cluster.prepare import CLUSTER_FEATURES, fit_cluster_prep
from shopsight.cluster.segments import business_labels
from shopsight.operators.aggregates import cluster_profile, cluster_summary
from shopsight.operators.joins import map_labels
from shopsight.operators.ranking import global_rank
from shopsight.session import build_session, cut_lineage
from shopsight.sources.readers import read_parquet_table
from shopsight.sources.writers import write_metadata, write_table


@dataclass
class Segmentation:
    customers: DataFrame
    prep: PipelineModel
    model: CentreModel
    k: int
    sweep: DataFrame
    mixtures: DataFrame | None
    comparison: DataFrame
    profile: DataFrame
    summary: DataFrame
    labels: DataFrame
    eps: float


def with_numeric_id(df: DataFrame, id_column: str) -> DataFrame:
    """Methods that order rows need a whole-number id; other ids get their place in the order of a hash of them.

    Ids whose hashes are equal have places of their own, so no two customers ever share a number.
    """
    if dict(df.dtypes)[id_column] in ("bigint", "int"):
        return df.withColumn("_row", F.col(id_column).cast("long"))
    hashes = [F.xxhash64(id_column), F.xxhash64(id_column, F.lit(1))]
    return global_rank(df, [*hashes, id_column], "_row")


def segment_customers(
    customers: DataFrame,
    id_column: str = "customer_unique_id",
    k: int | None = None,
    ks: Iterable[int] = range(2, 9),
    seed: int = 42,
    restarts: int = 10,
    mixture_restarts: int = 5,
    sweep_mixtures: bool = True,
    silhouette: str = "squared",
) -> Segmentation:
    """k None takes the silhouette's best; K-Means is the method that names the segments."""
    prep = fit_cluster_prep(customers)
    numbered = cut_lineage(with_numeric_id(customers, id_column))
    vectors = cut_lineage(prep.transform(numbered).select("_row", "features")).persist()
    ks = list(ks)
    # one set of passes fits the models of the sweep and the one that is used
    centres = fit_many(vectors, [*ks, *([] if k is None else [k])], seed, restarts)
    sweep = sweep_kmeans(vectors, "_row", ks, seed, restarts, silhouette, models=centres)
    k = best_k(sweep) if k is None else k
    model = centres[k]
    labelled = model.transform(vectors).withColumnRenamed("prediction", "kmeans")

    eps = suggest_eps(k_distances(vectors, "_row", 5))[0.95]
    n = vectors.count()
    dense = dbscan(vectors, "_row", eps, max(10, n // 1000)).withColumnRenamed("cluster", "dbscan")
    tree = hierarchical(vectors, "_row", k, seed=seed).withColumnRenamed("cluster", "hierarchical")
    fitted = fit_mixtures(vectors, list(dict.fromkeys([*(ks if sweep_mixtures else []), k])), seed, mixture_restarts)
    mixtures = sweep_gmm(vectors, ks, seed, mixture_restarts, models=fitted) if sweep_mixtures else None
    mixture = fitted[k]
    soft = gmm_labels(mixture, vectors).select("_row", F.col("cluster").alias("gmm"), "confidence")
    every = cut_lineage(labelled.join(dense, "_row").join(tree, "_row").join(soft, "_row"))
    methods = {"K-Means": "kmeans", "DBSCAN": "dbscan", "Hierarchical": "hierarchical", "GMM": "gmm"}
    comparison = compare_methods(every, methods, "_row", silhouette=silhouette)

    numbers = every.select("_row", F.col("kmeans").alias("cluster_id"))
    named = numbered.join(numbers, "_row").drop("_row")
    summary = cluster_summary(named, "cluster_id", CLUSTER_FEATURES)
    labels = business_labels(summary, frequency="frequency", monetary="monetary")
    return Segmentation(
        customers=map_labels(named, labels, "cluster_id", "customer_segment"),
        prep=prep,
        model=model,
        k=k,
        sweep=sweep,
        mixtures=mixtures,
        comparison=comparison,
        profile=cluster_profile(named, "cluster_id", CLUSTER_FEATURES),
        summary=summary,
        labels=labels,
        eps=eps,
    )


def save_segmentation(result: Segmentation, uri: str) -> None:
    """Fitted stages, tables and the clustered customers under one folder."""
    result.prep.write().overwrite().save(f"{uri}/preparation")
    result.model.save(f"{uri}/kmeans")
    write_table(result.customers, f"{uri}/customers")
    for name in ("sweep", "comparison", "profile", "summary", "labels"):
        write_table(getattr(result, name), f"{uri}/{name}", "csv")
    facts = {"k": result.k, "eps": result.eps, "features": CLUSTER_FEATURES}
    write_metadata(result.customers.sparkSession, facts, f"{uri}/metadata")


def load_segmentation(uri: str) -> tuple[PipelineModel, CentreModel]:
    return PipelineModel.load(f"{uri}/preparation"), CentreModel.load(f"{uri}/kmeans")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Segment customers")
    parser.add_argument("--input", required=True, help="parquet of the customer table, any Hadoop URI")
    parser.add_argument("--output", required=True)
    parser.add_argument("--k", type=int, default=4, help="0 picks the best silhouette")
    parser.add_argument("--k-min", type=int, default=2)
    parser.add_argument("--k-max", type=int, default=8)
    args = parser.parse_args(argv)
    spark = build_session("segmentation")
    customers = read_parquet_table(spark, args.input)
    result = segment_customers(customers, k=args.k or None, ks=range(args.k_min, args.k_max + 1))
    save_segmentation(result, args.output)


if __name__ == "__main__":
    main()

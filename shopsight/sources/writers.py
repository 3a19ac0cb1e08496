"""Writers for data, fitted parameters and reports. Nothing is collected on the way out."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_splits(df: DataFrame, uri: str, split_column: str = "split") -> None:
    """One dataset, one folder per split, so reading a split touches only its files."""
    if split_column != "split":
        df = df.withColumnRenamed(split_column, "split")
    df.write.mode("overwrite").partitionBy("split").parquet(uri)


def write_split_ids(assigned: DataFrame, id_column: str, uri: str, strategy: str = "time_based") -> None:
    """Membership (id, split) and a small counts table beside it."""
    ids = assigned.select(id_column, "split").distinct()
    ids.write.mode("overwrite").partitionBy("split").parquet(f"{uri}/ids")
    written = assigned.sparkSession.read.parquet(f"{uri}/ids")
    counts = written.groupBy("split").agg(F.count("*").alias("n_ids"))
    counts.withColumn("strategy", F.lit(strategy)).write.mode("overwrite").json(f"{uri}/counts")


def read_split_ids(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.parquet(f"{uri}/ids")


def write_table(df: DataFrame, uri: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(uri)


def write_metadata(spark: SparkSession, metadata: Mapping, uri: str) -> None:
    """One JSON row describing a run: names, parameters, metrics."""
    row = json.dumps(dict(metadata), default=str)
    spark.createDataFrame([(row,)], "metadata string").write.mode("overwrite").text(uri)


def read_metadata(spark: SparkSession, uri: str) -> dict:
    return json.loads(spark.read.text(uri, wholetext=True).first()[0])


def long_report(results: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of different shapes as one table: report, row key, metric, value as text."""
    parts = []
    for name, df in results.items():
        key = F.col(df.columns[0]).cast("string").alias("item")
        metrics = df.columns[1:]
        wide = df.select(key, *[F.col(c).cast("string").alias(c) for c in metrics])
        parts.append(
            wide.unpivot(["item"], metrics, "metric", "value").select(F.lit(name).alias("report"), "*")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_report(results: Mapping[str, DataFrame], uri: str, fmt: str = "json") -> None:
    write_table(long_report(results), uri, fmt)

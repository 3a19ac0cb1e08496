"""Readers. Every path may be any URI a Hadoop file system understands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopsight.sources.schemas import DATE_COLUMNS, RAW_SCHEMAS


def read_raw_tables(
    spark: SparkSession,
    files: Mapping[str, str],
    schemas: Mapping | None = None,
    parse_dates: bool = True,
) -> dict[str, DataFrame]:
    """Open the named CSV files lazily; a file that is missing is reported by name."""
    schemas = {**RAW_SCHEMAS, **(schemas or {})}
    tables = {}
    for name, path in files.items():
        if name not in schemas:
            raise ValueError(f"no schema is known for table '{name}'")
        reader = spark.read.option("header", True).option("multiLine", name == "reviews").option("escape", '"')
        try:
            tables[name] = reader.schema(schemas[name]).csv(path)
        except AnalysisException as problem:
            raise FileNotFoundError(f"table '{name}': nothing to read at {path}") from problem
    return parse_date_columns(tables) if parse_dates else tables


def lenient_timestamp(column: Column | str) -> Column:
    """Text to timestamp; anything unreadable becomes null."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def parse_date_columns(
    tables: Mapping[str, DataFrame], date_columns: Mapping[str, Sequence[str]] | None = None
) -> dict[str, DataFrame]:
    date_columns = DATE_COLUMNS if date_columns is None else date_columns
    parsed = {}
    for name, df in tables.items():
        present = [c for c in date_columns.get(name, []) if c in df.columns]
        parsed[name] = df.withColumns({c: lenient_timestamp(F.col(c).cast("string")) for c in present})
    return parsed


def mean_coordinates(geolocation: DataFrame) -> DataFrame:
    """One coordinate pair per zip prefix: the mean over its rows."""
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("geolocation_lat"),
        F.avg("geolocation_lng").alias("geolocation_lng"),
    )


def read_parquet_table(
    spark: SparkSession, uri: str, columns: Sequence[str] | None = None, schema: str | None = None
) -> DataFrame:
    """A parquet table with instants as TIMESTAMP, optionally only some columns or with a known schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(uri)
    if columns:
        df = df.select(*columns)
    ntz = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def read_split(spark: SparkSession, uri: str, split: str | None = None) -> DataFrame:
    """The split dataset; a split name prunes to that partition folder."""
    df = spark.read.parquet(uri)
    return df.where(F.col("split") == split).drop("split") if split else df

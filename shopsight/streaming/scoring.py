"""Scoring a stream and keeping a sampled log of predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from shopsight.learn.models import scored


def sampled_log(df: DataFrame, id_column: str, rate: float = 0.1, seed: int = 42) -> DataFrame:
    """A fixed share of ids, by hash: the same id is always in or out, on a batch or a stream."""
    digest = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(1_000_000)
    return df.where(bucket < round(rate * 1_000_000))


def score_stream(
    stream: DataFrame, model: PipelineModel, id_column: str, output_uri: str, checkpoint_uri: str, log_rate: float | None = None
) -> StreamingQuery:
    """Predictions of arriving rows to parquet; with `log_rate` only the sampled ones."""
    out = scored(model, stream).select(id_column, "prediction", "score")
    if log_rate is not None:
        out = sampled_log(out, id_column, log_rate)
    return (
        out.writeStream.format("parquet")
        .option("path", output_uri)
        .option("checkpointLocation", checkpoint_uri)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

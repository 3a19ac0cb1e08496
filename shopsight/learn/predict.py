"""Batch scoring: validate, apply the stored pipelines, write predictions and rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from shopsight.learn.models import scored
from shopsight.operators.quality import Rule, split_valid


def predict_satisfaction(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = scored(model, df)
    return out.select(*keep, F.col("prediction").cast("int").alias("is_satisfied_pred"), F.col("score").alias("satisfaction_probability"))


def predict_delivery(model: PipelineModel, df: DataFrame, keep: Sequence[str], log_scale: bool = True) -> DataFrame:
    """Days until delivery, never negative."""
    days = F.expm1("prediction") if log_scale else F.col("prediction")
    return model.transform(df).select(*keep, F.greatest(days, F.lit(0.0)).alias("delivery_days_pred"))


def batch_predict(
    df: DataFrame,
    rules: Sequence[Rule],
    id_column: str,
    satisfaction: PipelineModel | None = None,
    delivery: PipelineModel | None = None,
    output_uri: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(predictions per id, rejected rows with reasons); both are written when a place is given."""
    valid, rejected = split_valid(df, rules)
    out = valid.select(id_column)
    if satisfaction is not None:
        out = predict_satisfaction(satisfaction, valid, [id_column])
    if delivery is not None:
        days = predict_delivery(delivery, valid, [id_column])
        out = days if satisfaction is None else out.join(days, id_column)
    if output_uri:
        out.write.mode("overwrite").parquet(f"{output_uri}/predictions")
        rejected.write.mode("overwrite").parquet(f"{output_uri}/rejected")
    return out, rejected

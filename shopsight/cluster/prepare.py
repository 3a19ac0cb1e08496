"""From the customer table to standardised vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from shopsight.operators.encode import StandardScaler, scaling_stage

# Features that describe a customer, and those taken on a log scale.
CLUSTER_FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "avg_review_score",
    "avg_delivery_days",
    "late_delivery_rate",
]
LOG_FEATURES = ["frequency", "monetary"]


def fit_cluster_prep(
    customers: DataFrame,
    features: Sequence[str] = tuple(CLUSTER_FEATURES),
    log_features: Sequence[str] = tuple(LOG_FEATURES),
) -> PipelineModel:
    """log1p, median fill, standardisation and assembly; applies unchanged to new customers."""
    names = [f"{c}_log" if c in log_features else c for c in features]
    logged = customers.withColumns({f"{c}_log": F.log1p(c) for c in features if c in log_features})
    scaler = StandardScaler(names).fit(logged)
    stage = scaling_stage(scaler, logs=[f"{c}_log" for c in log_features])
    assembler = VectorAssembler(inputCols=[f"{c}_z" for c in names], outputCol="features")
    return Pipeline(stages=[stage, assembler]).fit(customers)


def scaled_names(features: Sequence[str], log_features: Sequence[str]) -> list[str]:
    return [f"{c}_log_z" if c in log_features else f"{c}_z" for c in features]

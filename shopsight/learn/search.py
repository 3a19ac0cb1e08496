"""Cross-validation on given folds and random parameter search."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

# The search spaces of the boosted models. Spark trees have no limit on leaves; the number of
# candidate splits (maxBins) takes that place in the space.
CLASSIFIER_SPACE = {
    "maxIter": [100, 200, 300],
    "maxDepth": [5, 10, 15],
    "stepSize": [0.01, 0.05, 0.1],
    "maxBins": [31, 50, 100],
    "minInstancesPerNode": [20, 50, 100],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}
REGRESSOR_SPACE = {
    "maxIter": [100, 200, 300],
    "maxDepth": [5, 10, 15, 20],
    "stepSize": [0.01, 0.05, 0.1],
    "maxBins": [31, 50, 100],
    "minInstancesPerNode": [10, 20, 50],
    "subsamplingRate": [0.8, 0.9, 1.0],
}


def sampled_grid(estimator: Estimator, space: Mapping[str, Sequence], n: int = 30, seed: int = 42) -> list[dict]:
    """n different combinations of the space, as parameter maps."""
    names = list(space)
    combos = list(product(*[space[k] for k in names]))
    chosen = random.Random(seed).sample(combos, min(n, len(combos)))
    return [{estimator.getParam(k): v for k, v in zip(names, values)} for values in chosen]


def auc_evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    )


def cross_validate(
    estimator: Estimator,
    folded: DataFrame,
    grid: list[dict] | None = None,
    evaluator: Evaluator | None = None,
    folds: int = 5,
    fold_column: str = "fold",
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Fit every parameter map on every fold; the best one is refitted on all rows."""
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid or [{}],
        evaluator=evaluator or auc_evaluator(),
        numFolds=folds,
        foldCol=fold_column,
        parallelism=parallelism,
    ).fit(folded)


def search_report(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """One row per parameter map: parameters as text, mean and deviation of the score."""
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name)),
            float(mean),
            float(std),
        )
        for params, mean, std in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "params string, mean_score double, std_score double")


def time_series_scores(
    estimator: Estimator, blocked: DataFrame, evaluator: Evaluator, folds: int = 5, block_column: str = "block"
) -> DataFrame:
    """Score of each expanding window: train on blocks up to f, validate on the next one."""
    rows = []
    for f in range(folds):
        model = estimator.fit(blocked.where(F.col(block_column) <= f))
        rows.append((f, float(evaluator.evaluate(model.transform(blocked.where(F.col(block_column) == f + 1))))))
    scores = [s for _, s in rows]
    spark = blocked.sparkSession
    table = spark.createDataFrame(rows, "fold int, score double")
    return table.withColumns({"mean_score": F.lit(float(np.mean(scores))), "std_score": F.lit(float(np.std(scores)))})

"""Baselines, class weights and the estimators with the settings used for each task."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from shopsight.operators.ranking import medians

SEED = 42


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """label, n, weight: rows / (classes x rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("_all"), F.count("*").alias("_k"))
    return counts.join(totals).select(label, "n", (F.col("_all") / (F.col("_k") * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label: str = "label", output: str = "weight") -> DataFrame:
    """Add the balanced weight of the row's class, as a literal expression."""
    expr = None
    for r in class_weights(df, label).collect():
        hit = F.col(label) == F.lit(r[label])
        expr = F.when(hit, r["weight"]) if expr is None else expr.when(hit, r["weight"])
    return df.withColumn(output, F.lit(1.0) if expr is None else expr)


def majority_class(train: DataFrame, label: str = "label"):
    """The most frequent class, lowest on ties."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label)))).first()[0]


def predict_majority(train: DataFrame, df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumns({"prediction": F.lit(majority_class(train, label)), "score": F.lit(0.5)})


def predict_constant(train: DataFrame, df: DataFrame, label: str = "label", kind: str = "mean") -> DataFrame:
    """Regression baseline: the training mean or median for every row."""
    value = train.agg(F.avg(label)).first()[0] if kind == "mean" else medians(train, [label])[label]
    return df.withColumn("prediction", F.lit(value))


# Settings of each classifier and regressor.
def logistic_regression(n_rows: int, c: float = 1.0, max_iter: int = 1000, weight: str | None = "weight") -> LogisticRegression:
    """L2 with inverse strength c, on inputs that are already scaled."""
    model = LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * n_rows), elasticNetParam=0.0, standardization=False)
    return model.setWeightCol(weight) if weight else model


def decision_tree(weight: str | None = "weight", depth: int = 10, leaf: int = 10) -> DecisionTreeClassifier:
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)
    return model.setWeightCol(weight) if weight else model


def random_forest(weight: str | None = "weight", trees: int = 100, depth: int = 15, leaf: int = 5) -> RandomForestClassifier:
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)
    return model.setWeightCol(weight) if weight else model


def boosted_trees(weight: str | None = "weight", rounds: int = 200, depth: int = 10, rate: float = 0.1) -> GBTClassifier:
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)
    return model.setWeightCol(weight) if weight else model


def linear_regression() -> LinearRegression:
    return LinearRegression(maxIter=1000, regParam=0.0, standardization=False)


def ridge(n_rows: int, alpha: float = 1.0) -> LinearRegression:
    return LinearRegression(maxIter=1000, regParam=alpha / n_rows, elasticNetParam=0.0, standardization=False)


def lasso(alpha: float = 0.1) -> LinearRegression:
    return LinearRegression(maxIter=1000, regParam=alpha, elasticNetParam=1.0, standardization=False)


def tree_regressor(depth: int = 10, leaf: int = 10) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)


def forest_regressor(trees: int = 100, depth: int = 15, leaf: int = 5) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)


def boosted_regressor(rounds: int = 200, depth: int = 10, rate: float = 0.1) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)


def scored(model, df: DataFrame) -> DataFrame:
    """Predictions with `score`, the probability of class 1 (the prediction itself for a regressor)."""
    out = model.transform(df)
    score = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
    return out.withColumn("score", score)


def fit_weighted(estimator: Estimator, train: DataFrame, label: str = "label"):
    """Fit on rows weighted to balance the classes."""
    return estimator.fit(with_weights(train, label))

"""Satisfaction and delivery-time models: train, compare, choose, describe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, functions as F

from shopsight.learn.metrics import compare_models, evaluate_classifier, evaluate_regressor
from shopsight.learn.models import (
    boosted_regressor,
    boosted_trees,
    decision_tree,
    forest_regressor,
    linear_regression,
    lasso,
    logistic_regression,
    predict_constant,
    predict_majority,
    random_forest,
    ridge,
    scored,
    tree_regressor,
    with_weights,
)
from shopsight.operators.encode import fit_preprocessor
from shopsight.sources.writers import write_metadata, write_table

# Features of the satisfaction model.
SATISFACTION_NUMERIC = [
    "delivery_days",
    "delivery_delay_days",
    "price",
    "freight_value",
    "payment_value",
    "payment_installments",
    "freight_ratio",
    "price_vs_category_zscore",
    "payment_per_installment",
    "product_weight_g",
    "product_volume_cm3",
    "product_photos_qty",
    "seller_customer_distance_km",
    "review_text_length",
    "review_word_count",
    "review_caps_ratio",
    "review_sentiment_polarity",
    "review_sentiment_subjectivity",
    "order_hour_sin",
    "order_hour_cos",
    "order_dayofweek_sin",
    "order_dayofweek_cos",
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
]


@dataclass
class Trained:
    preprocessor: PipelineModel
    models: dict[str, object]
    comparison: DataFrame

    def best(self, by: str = "roc_auc", highest: bool = True) -> str:
        pick = F.max_by if highest else F.min_by
        return self.comparison.where(F.col("name").isin(list(self.models))).agg(pick("name", by)).first()[0]

    def full_model(self, name: str) -> PipelineModel:
        """Preprocessing and model as one savable pipeline."""
        return PipelineModel(stages=[*self.preprocessor.stages, self.models[name]])


def default_classifiers(n_rows: int) -> dict[str, Estimator]:
    return {
        "Logistic Regression": logistic_regression(n_rows),
        "Decision Tree": decision_tree(),
        "Random Forest": random_forest(),
        "Gradient Boosting": boosted_trees(),
    }


def default_regressors(n_rows: int) -> dict[str, Estimator]:
    return {
        "Linear Regression": linear_regression(),
        "Ridge": ridge(n_rows),
        "Lasso": lasso(),
        "Decision Tree": tree_regressor(),
        "Random Forest": forest_regressor(),
        "Gradient Boosting": boosted_regressor(),
    }


def train_classifiers(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
    label: str = "is_satisfied",
    estimators: Mapping[str, Estimator] | None = None,
) -> Trained:
    """Preprocessing on train, the majority baseline and every estimator, judged on validation rows."""
    train, val = (d.withColumn("label", F.col(label).cast("double")) for d in (train, val))
    prep = fit_preprocessor(train, numeric, categorical, binary)
    fit_rows = with_weights(prep.transform(train).select("features", "label"), "label").persist()
    check = prep.transform(val).select("features", "label").persist()
    chosen = estimators if estimators is not None else default_classifiers(fit_rows.count())
    rows = [evaluate_classifier(predict_majority(fit_rows, check), "Baseline")]
    models = {}
    for name, estimator in chosen.items():
        models[name] = estimator.fit(fit_rows)
        rows.append(evaluate_classifier(scored(models[name], check), name))
    return Trained(prep, models, compare_models(rows))


def train_regressors(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
    target: str = "delivery_days",
    estimators: Mapping[str, Estimator] | None = None,
) -> Trained:
    """The same on log1p of a non-negative target, rows without it left out; judged in original units."""
    train, val = (
        d.where(F.col(target) >= 0).withColumn("label", F.log1p(F.col(target).cast("double"))) for d in (train, val)
    )
    prep = fit_preprocessor(train, numeric, categorical, binary)
    fit_rows = prep.transform(train).select("features", "label").persist()
    check = prep.transform(val).select("features", "label").persist()
    chosen = estimators if estimators is not None else default_regressors(fit_rows.count())
    rows = [
        evaluate_regressor(predict_constant(fit_rows, check, kind=k), f"Baseline ({k})") for k in ("mean", "median")
    ]
    models = {}
    for name, estimator in chosen.items():
        models[name] = estimator.fit(fit_rows)
        rows.append(evaluate_regressor(models[name].transform(check), name))
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return Trained(prep, models, table.orderBy("rmse", "name"))


def save_trained(
    trained: Trained, name: str, uri: str, metadata: Mapping | None = None, importances: DataFrame | None = None
) -> None:
    """The chosen pipeline, the comparison, importances and one metadata row."""
    trained.full_model(name).write().overwrite().save(f"{uri}/model")
    write_table(trained.comparison, f"{uri}/comparison", "csv")
    if importances is not None:
        write_table(importances, f"{uri}/importances", "csv")
    facts = {"model_name": name, "algorithm": type(trained.models[name]).__name__, **(metadata or {})}
    metrics = trained.comparison.where(F.col("name") == name).first()
    facts["metrics"] = metrics.asDict() if metrics else {}
    write_metadata(trained.comparison.sparkSession, facts, f"{uri}/metadata")

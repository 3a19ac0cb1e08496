"""Model quality as aggregations over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.operators.profile import regression_target
from shopsight.operators.ranking import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def binary_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 of class 1; a ratio over nothing is 0."""
    hit = F.col(label) == F.col(prediction)
    row = df.agg(
        F.count_if((F.col(label) == 1) & hit).alias("tp"),
        F.count_if((F.col(label) == 0) & ~hit).alias("fp"),
        F.count_if((F.col(label) == 0) & hit).alias("tn"),
        F.count_if((F.col(label) == 1) & ~hit).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return row.select(
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_groups(df: DataFrame, label: str, score: str, round_to: int | None = None) -> DataFrame:
    """One row per distinct score (optionally rounded) with its positives and negatives."""
    value = F.col(score) if round_to is None else F.round(score, round_to)
    return df.groupBy(value.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def threshold_points(df: DataFrame, label: str = "label", score: str = "score", round_to: int | None = None) -> DataFrame:
    """Per distinct score, as a threshold 'score at least': tp, fp, tpr, fpr, precision, f1."""
    cumulated = running_totals(
        score_groups(df, label, score, round_to), ["score"], {"tp": "pos", "fp": "neg"}, descending=True
    )
    total = df.agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    tp, fp = F.col("tp"), F.col("fp")
    return cumulated.join(total).select(
        "score",
        "pos",
        "neg",
        "tp",
        "fp",
        F.try_divide(tp, F.col("_p")).alias("tpr"),
        F.try_divide(fp, F.col("_n")).alias("fpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
        _ratio(2 * tp, tp + fp + F.col("_p")).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counting half; null with one class only."""
    points = threshold_points(df, label, score)
    above = F.col("tp") - F.col("pos")
    wins = F.sum(F.col("neg") * (above + F.col("pos") / 2))
    return points.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def evaluate_classifier(
    df: DataFrame, name: str, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    return binary_counts(df, label, prediction).join(roc_auc(df, label, score)).select(F.lit(name).alias("name"), "*")


def best_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold with the highest F1 (the highest threshold on ties)."""
    points = threshold_points(df, label, score)
    best = F.max_by(F.struct("score", "f1", "tpr", "precision"), F.struct("f1", "score")).alias("b")
    return points.agg(best).select(
        F.col("b.score").alias("threshold"),
        F.col("b.f1").alias("f1"),
        F.col("b.tpr").alias("recall"),
        F.col("b.precision").alias("precision"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, and their plain and weighted means."""
    cells = confusion(df, label, prediction)
    true = cells.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("support"))
    said = cells.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("said"))
    right = cells.where("label = prediction").select(F.col("label").alias("c"), F.col("n").alias("hit"))
    table = true.join(said, "c", "full").join(right, "c", "left").na.fill(0, ["support", "said", "hit"])
    hit, support, told = F.col("hit"), F.col("support"), F.col("said")
    per_class = table.select(
        F.col("c").cast("string").alias("class"),
        _ratio(hit, told).alias("precision"),
        _ratio(hit, support).alias("recall"),
        _ratio(2 * hit, told + support).alias("f1"),
        "support",
    )
    scores = ("precision", "recall", "f1")
    macro = per_class.agg(*[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores],
        F.sum("support").alias("support"),
    )
    return (
        per_class.unionByName(macro.withColumn("class", F.lit("macro avg")))
        .unionByName(weighted.withColumn("class", F.lit("weighted avg")))
        .select("class", *scores, "support")
    )


def compare_models(rows: list[DataFrame], by: str = "roc_auc") -> DataFrame:
    """All evaluations as one table, best first."""
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.orderBy(F.col(by).desc_nulls_last(), "name")


def best_model(comparison: DataFrame, by: str = "roc_auc", highest: bool = True) -> DataFrame:
    pick = F.max_by if highest else F.min_by
    return comparison.agg(pick("name", by).alias("name"), (F.max(by) if highest else F.min(by)).alias(by))


def evaluate_regressor(
    df: DataFrame, name: str, label: str = "label", prediction: str = "prediction", log_scale: bool = True
) -> DataFrame:
    """rmse, mae, r2 and mape in days; `log_scale` undoes log1p on both sides first."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    if log_scale:
        y, p = F.expm1(y), F.expm1(p)
    both = df.select(y.alias("y"), p.alias("p"))
    error = F.col("y") - F.col("p")
    row = both.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop("y") * F.count("y"))).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, F.col("y")))) * 100).alias("mape"),
    )
    return row.select(F.lit(name).alias("name"), "*")


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(prediction) - F.col(label))


def residual_summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return regression_target(residuals(df, label, prediction), "residual")

"""Supervised learning. Document quality from text statistics stands for satisfaction."""

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded
from shopsight.functions.calendar import add_calendar_features
from shopsight.functions.text import add_text_features
from shopsight.learn import explain as X, metrics as M, models as L, search as S
from shopsight.learn.predict import batch_predict
from shopsight.operators.encode import feature_names, fit_preprocessor
from shopsight.operators.quality import Rule
from shopsight.operators.ranking import running_totals
from shopsight.operators.split import assign_time_split, expanding_folds, stratified_folds
from shopsight.operators.targets import add_targets
from shopsight.plans.satisfaction import save_trained, train_classifiers, train_regressors
from shopsight.session import scratch_uri
from shopsight.sources import bindings

_NUMERIC = ["n_chars", "review_word_count", "review_exclamation_count", "review_question_count", "review_caps_ratio"]
_CATEGORICAL = ["lang"]
_BINARY = ["toxic"]


def _documents(spark, sf):
    labelled = bindings.table(spark, sf, "labels").join(bindings.table(spark, sf, "documents"), "doc_id")
    return add_text_features(labelled, "text").drop("text").withColumn("label", F.col("quality").cast("double"))


def _prepared(spark, sf):
    df = _documents(spark, sf).persist()
    model = fit_preprocessor(df, _NUMERIC, _CATEGORICAL, _BINARY)
    return df, model, L.with_weights(model.transform(df).select("doc_id", "features", "label")).persist()


def _events(spark, sf):
    """Purchases, scored by their value: many equal scores."""
    return bindings.table(spark, sf, "events").select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        F.round("value", 0).alias("score"),
        (F.round("value", 0) >= 20).cast("int").alias("prediction"),
    )


_EV = """WITH ev AS (SELECT event_id, CAST(event_type = 'purchase' AS INT) AS label, round(value, 0) AS score,
  CAST(round(value, 0) >= 20 AS INT) AS prediction FROM events),
c AS (SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 1 AND prediction = 0) AS fn FROM ev),
g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM ev GROUP BY score),
pts AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g),
auc AS (SELECT sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS auc FROM pts)
"""


@query("l1_majority", "SELECT doc_id, 1 AS prediction, 0.5::DOUBLE AS score FROM labels")
def majority(spark, sf):
    labels = bindings.table(spark, sf, "labels")
    return L.predict_majority(labels, labels, "quality").select(
        "doc_id", F.col("prediction").cast("int").alias("prediction"), "score"
    )


@query(
    "l2_class_weights",
    """SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 4) AS weight
    FROM labels GROUP BY quality""",
)
def weights(spark, sf):
    return rounded(L.class_weights(bindings.table(spark, sf, "labels"), "quality"))


def _parts(spark, sf):
    """Four fifths of the documents to learn from and one to judge on, dealt by id within each class."""
    df = stratified_folds(_documents(spark, sf), "doc_id", "label", seed=None).persist()
    return df.where("fold < 4"), df.where("fold = 4")


def _held_out(spark, sf, estimator):
    """Held-out documents, scored by a model of the others."""
    train, held = _parts(spark, sf)
    prep = fit_preprocessor(train, _NUMERIC, _CATEGORICAL, _BINARY)
    rows = L.with_weights(prep.transform(train).select("features", "label")).persist()
    return L.scored(estimator(rows).fit(rows), prep.transform(held).select("doc_id", "features", "label"))


def _judged(spark, sf, estimator, name):
    return rounded(M.evaluate_classifier(_held_out(spark, sf, estimator), name))


def _valid(spark, sf, estimator):
    """Held-out documents, those without a class and a score in 0..1, and whether the AUC is that of the scores' ranks."""
    found = _held_out(spark, sf, estimator).persist()
    sound = F.col("prediction").isin(0.0, 1.0) & F.col("score").between(0, 1)
    sizes = found.agg(F.count("*").alias("documents"), (F.count("*") - F.count_if(sound)).alias("off"))
    tied = found.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    below = running_totals(tied, ["score"], {"negatives": "neg"})
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("negatives") - F.col("neg") / 2)), F.sum("pos") * F.sum("neg"))
    both = below.agg(auc.alias("auc")).join(M.evaluate_classifier(found, "model").select("roc_auc"))
    return sizes.join(both.select(F.coalesce(F.abs(F.col("auc") - F.col("roc_auc")) < 1e-9, F.lit(True)).alias("auc_agrees")))


_VALID = """SELECT count(*) AS documents, 0::BIGINT AS off, true AS auc_agrees FROM (
  SELECT row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS place FROM labels JOIN documents USING (doc_id)) WHERE (place - 1) % 5 = 4"""


def _logistic(rows):
    return L.logistic_regression(rows.count())


def _boosted(rows):
    return L.boosted_trees(rounds=15, depth=4)


@query("l3_logistic_regression")
def logistic(spark, sf):
    return _judged(spark, sf, _logistic, "Logistic Regression")


@query("l3_held_out", _VALID)
def logistic_held_out(spark, sf):
    return _valid(spark, sf, _logistic)


@query("l4_decision_tree")
def tree(spark, sf):
    return _judged(spark, sf, lambda rows: L.decision_tree(), "Decision Tree")


@query("l4_held_out", _VALID)
def tree_held_out(spark, sf):
    return _valid(spark, sf, lambda rows: L.decision_tree())


@query("l5_random_forest")
def forest(spark, sf):
    return _judged(spark, sf, lambda rows: L.random_forest(), "Random Forest")


@query("l5_held_out", _VALID)
def forest_held_out(spark, sf):
    return _valid(spark, sf, lambda rows: L.random_forest())


@query("l6_boosted_trees")
def boosted(spark, sf):
    return _judged(spark, sf, _boosted, "Gradient Boosting")


@query("l6_held_out", _VALID)
def boosted_held_out(spark, sf):
    return _valid(spark, sf, _boosted)


@query("l7_cross_validation")
def cross_validation(spark, sf):
    _, _, rows = _prepared(spark, sf)
    folded = stratified_folds(rows, "doc_id", "label").persist()
    model = S.cross_validate(L.logistic_regression(rows.count()), folded)
    return rounded(S.search_report(model, rows))


@query("l8_random_search")
def search(spark, sf):
    _, _, rows = _prepared(spark, sf)
    folded = stratified_folds(rows, "doc_id", "label", folds=3).persist()
    base = L.boosted_trees()
    space = {**S.CLASSIFIER_SPACE, "maxIter": [5, 10], "maxDepth": [2, 3], "minInstancesPerNode": [5, 10]}
    model = S.cross_validate(base, folded, S.sampled_grid(base, space, 3), folds=3)
    return rounded(S.search_report(model, rows))


@query(
    "l9_classification_metrics",
    _EV
    + """SELECT 'value' AS name, round((tp + tn) / (tp + fp + tn + fn), 4) AS accuracy, round(tp / (tp + fp), 4) AS precision,
      round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, round(auc, 4) AS roc_auc FROM c, auc""",
)
def metrics(spark, sf):
    return rounded(M.evaluate_classifier(_events(spark, sf), "value"))


@query("l10_confusion", _EV + "SELECT label, prediction, count(*) AS n FROM ev GROUP BY ALL")
def confusion(spark, sf):
    return M.confusion(_events(spark, sf))


@query(
    "l10_classification_report",
    _EV
    + """, k AS (SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM c
      UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
    a AS (SELECT * FROM k UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM k
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM k)
    SELECT class, support, """
    + r("precision", "recall", "f1")
    + " FROM a",
)
def report(spark, sf):
    return rounded(M.classification_report(_events(spark, sf)))


@query(
    "l11_roc_points",
    _EV + "SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / p, 4) AS tpr, round(fp / n, 4) AS fpr FROM pts",
)
def roc(spark, sf):
    return rounded(M.threshold_points(_events(spark, sf)).select("score", "tp", "fp", "tpr", "fpr"))


@query(
    "l11_precision_recall_points",
    _EV + "SELECT score, round(tp / p, 4) AS recall, round(tp / (tp + fp), 4) AS precision FROM pts",
)
def precision_recall(spark, sf):
    return rounded(M.threshold_points(_events(spark, sf)).select("score", F.col("tpr").alias("recall"), "precision"))


@query(
    "l12_model_comparison",
    _EV
    + """SELECT 'always 1' AS name, round(count_if(label = 1) / count(*), 4) AS accuracy, 0.5::DOUBLE AS roc_auc FROM ev
    UNION ALL SELECT 'value', round((tp + tn) / (tp + fp + tn + fn), 4), round(auc, 4) FROM c, auc""",
)
def comparison(spark, sf):
    events = _events(spark, sf)
    constant = events.withColumns({"prediction": F.lit(1), "score": F.lit(0.5)})
    rows = [M.evaluate_classifier(constant, "always 1"), M.evaluate_classifier(events, "value")]
    return rounded(M.compare_models(rows).select("name", "accuracy", "roc_auc"))


@query("l13_shapley")
def shapley(spark, sf):
    """Mean absolute contributions, with the largest gap between their sum and the score difference."""
    df, prep, rows = _prepared(spark, sf)
    model = L.random_forest(trees=20, depth=5).fit(rows)
    background = X.mean_background(rows)
    sample = X.sample_rows(rows, "doc_id")
    values = X.shapley_values(model, sample, "doc_id", background, permutations=3).persist()
    return rounded(X.attribution_summary(values, feature_names(prep, df)))


@query("l13_shapley_sums", "SELECT count(*) AS documents, 0 AS off FROM labels")
def shapley_sums(spark, sf):
    """Per document the contributions add up to the score minus the background score."""
    from pyspark.ml.functions import array_to_vector

    _, _, rows = _prepared(spark, sf)
    model = L.random_forest(trees=10, depth=4).fit(rows)
    background = X.mean_background(rows)
    values = X.shapley_values(model, rows, "doc_id", background, permutations=2)
    sums = values.groupBy("doc_id").agg(F.sum("contribution").alias("total"))
    point = spark.range(1).select(array_to_vector(F.array(*[F.lit(v) for v in background])).alias("features"))
    base = L.scored(model, point).first()["score"]
    gaps = L.scored(model, rows).join(sums, "doc_id").select(F.abs(F.col("score") - base - F.col("total")).alias("gap"))
    return gaps.agg(F.count("*").alias("documents"), F.count_if(F.col("gap") > 1e-9).cast("int").alias("off"))


@query("w4_top_importances")
def importances(spark, sf):
    df, prep, rows = _prepared(spark, sf)
    model = L.random_forest(trees=20, depth=5).fit(rows)
    return rounded(X.tree_importances(model, feature_names(prep, df), spark).limit(10))


@query("l13_linear_attributions")
def linear(spark, sf):
    df, prep, rows = _prepared(spark, sf)
    model = L.logistic_regression(rows.count()).fit(rows)
    values = X.linear_attributions(list(model.coefficients), rows, "doc_id", X.mean_background(rows))
    return rounded(X.attribution_summary(values, feature_names(prep, df)))


@query("l15_permutation_importance")
def permutation(spark, sf):
    df, prep, rows = _prepared(spark, sf)
    model = L.random_forest(trees=20, depth=5).fit(rows)
    return rounded(X.named(X.permutation_importance(model, rows, "doc_id"), feature_names(prep, df)))


def _deliveries(spark, sf):
    orders = add_targets(bindings.orders(spark, sf).join(bindings.reviews(spark, sf).drop("review_comment_message"), "order_id", "left"))
    return add_calendar_features(orders)


@query(
    "l16_baselines",
    W
    + """, d AS (SELECT delivery_days AS y FROM (SELECT DISTINCT order_id, delivery_days FROM tw) WHERE delivery_days IS NOT NULL)
    SELECT round(avg(y), 4) AS mean, round(quantile_cont(y, 0.5), 4) AS median FROM d""",
)
def baselines(spark, sf):
    days = _deliveries(spark, sf).where(F.col("delivery_days").isNotNull()).select(F.col("delivery_days").alias("label"))
    both = L.predict_constant(days, days, kind="mean").withColumnRenamed("prediction", "mean")
    both = L.predict_constant(days, both, kind="median").withColumnRenamed("prediction", "median")
    return rounded(both.select("mean", "median").distinct())


@query("l16_regressors")
def regressors(spark, sf):
    days = assign_time_split(_deliveries(spark, sf))
    train, val = days.where("split = 'train'"), days.where("split = 'val'")
    chosen = {
        "Linear Regression": L.linear_regression(),
        "Ridge": L.ridge(train.count()),
        "Lasso": L.lasso(),
        "Decision Tree": L.tree_regressor(5),
        "Random Forest": L.forest_regressor(10, 5),
        "Gradient Boosting": L.boosted_regressor(5, 3),
    }
    trained = train_regressors(
        train, val, ["order_hour_sin", "order_hour_cos", "order_month", "review_score"], ["order_status"], ["is_weekend"], estimators=chosen
    )
    return rounded(trained.comparison)


def _predicted(spark, sf):
    guess = F.log1p(F.lit(20.0) + F.col("order_id") % 10)
    known = _deliveries(spark, sf).where(F.col("delivery_days").isNotNull())
    return known.select("order_id", F.log1p("delivery_days").alias("label"), guess.alias("prediction"))


_PRED = W + """, d AS (SELECT DISTINCT order_id, delivery_days AS y, 20.0::DOUBLE + order_id % 10 AS p FROM tw WHERE delivery_days IS NOT NULL)
"""


@query(
    "l17_regression_metrics",
    _PRED
    + """, x AS (SELECT sqrt(avg(pow(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae, 1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS r2,
      avg(abs((y - p) / y)) * 100 AS mape FROM d) SELECT 'guess' AS name, """
    + r("rmse", "mae", "r2", "mape")
    + " FROM x",
)
def regression_metrics(spark, sf):
    return rounded(M.evaluate_regressor(_predicted(spark, sf), "guess"))


@query("l18_best_model")
def best(spark, sf):
    """Chosen on validation documents, then judged once on the held-out ones."""
    df = stratified_folds(_documents(spark, sf), "doc_id", "label").persist()
    train, val, test = df.where("fold < 3"), df.where("fold = 3"), df.where("fold = 4")
    chosen = {"Logistic Regression": L.logistic_regression(train.count()), "Decision Tree": L.decision_tree()}
    trained = train_classifiers(train, val, _NUMERIC, _CATEGORICAL, _BINARY, "quality", chosen)
    name = trained.best()
    return rounded(M.evaluate_classifier(L.scored(trained.full_model(name), test), name))


@query("l19_time_series_scores")
def time_series(spark, sf):
    days = _deliveries(spark, sf).where(F.col("delivery_days").isNotNull()).withColumn("label", F.log1p("delivery_days"))
    prep = fit_preprocessor(days, ["order_hour_sin", "order_month"], ["order_status"], ["is_weekend"])
    blocked = expanding_folds(days, "order_purchase_timestamp", "order_id", 3).persist()
    ready = prep.transform(blocked).select("features", "label", "block").persist()
    return rounded(S.time_series_scores(L.linear_regression(), ready, RegressionEvaluator(metricName="rmse"), 3))


@query(
    "l20_best_threshold",
    _EV
    + """, f AS (SELECT score, 2 * tp / (tp + fp + p) AS f1, tp / p AS recall, tp / (tp + fp) AS precision FROM pts)
    SELECT score AS threshold, round(f1, 4) AS f1, round(recall, 4) AS recall, round(precision, 4) AS precision
    FROM f ORDER BY f1 DESC, score DESC LIMIT 1""",
)
def threshold(spark, sf):
    return rounded(M.best_threshold(_events(spark, sf)))


@query(
    "l21_residuals",
    _PRED + ", x AS (SELECT order_id, ln(1 + p) - ln(1 + y) AS residual FROM d) SELECT order_id, " + r("residual") + " FROM x",
)
def residuals(spark, sf):
    return rounded(M.residuals(_predicted(spark, sf)).select("order_id", "residual"))


@query(
    "l21_residual_summary",
    _PRED + """, x AS (SELECT ln(1 + p) - ln(1 + y) AS e FROM d)
    SELECT count(*) AS total_samples, round(avg(e), 2) AS mean, round(quantile_cont(e, 0.5), 2) AS median, round(stddev_samp(e), 2) AS std FROM x""",
)
def residual_summary(spark, sf):
    return M.residual_summary(_predicted(spark, sf)).select("total_samples", "mean", "median", "std")


@query("l22_batch_prediction")
def batch(spark, sf):
    """Train, save, load, score all documents; documents in one language are rejected by a rule."""
    df = _documents(spark, sf).persist()
    train, held = _parts(spark, sf)
    trained = train_classifiers(train, held, _NUMERIC, _CATEGORICAL, _BINARY, "quality", {"Decision Tree": L.decision_tree()})
    uri = scratch_uri(spark, "model")
    save_trained(trained, "Decision Tree", uri, {"features": _NUMERIC + _CATEGORICAL + _BINARY})
    rules = [Rule("doc_id", "integer", nullable=False), Rule("lang", "string", allowed=("en", "fr", "es")), Rule("n_chars", "number", low=1)]
    out, rejected = batch_predict(df, rules, "doc_id", PipelineModel.load(f"{uri}/model"), output_uri=uri)
    kept = out.groupBy(F.col("is_satisfied_pred").cast("string").alias("outcome")).agg(F.count("*").alias("n"))
    return kept.unionByName(rejected.select(F.lit("rejected").alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n")))

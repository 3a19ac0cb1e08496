import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shopsight.learn import explain as X, metrics as M, models as L, search as S
from shopsight.operators.split import expanding_folds, stratified_folds


def scores(spark, rows):
    return spark.createDataFrame(rows, "label int, score double").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_auc_counts_ties_half(spark):
    assert M.roc_auc(scores(spark, [(1, 0.5), (0, 0.5)])).first().roc_auc == 0.5
    assert M.roc_auc(scores(spark, [(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)])).first().roc_auc == 0.875
    assert M.roc_auc(scores(spark, [(1, 0.9), (1, 0.1)])).first().roc_auc is None


def test_auc_matches_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.random() < 0.3), round(float(rng.random()), 2)) for _ in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert M.roc_auc(scores(spark, rows)).first().roc_auc == pytest.approx(wins)


def test_empty_ratios_are_zero(spark):
    row = M.binary_counts(scores(spark, [(0, 0.1), (0, 0.2)])).first()
    assert tuple(row) == (1.0, 0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 1.0)], "label double, prediction double")
    row = M.evaluate_regressor(df, "m", log_scale=False).first()
    assert row.rmse == pytest.approx((2 / 3) ** 0.5) and row.mae == pytest.approx(2 / 3) and row.mape == pytest.approx(50.0)
    assert row.r2 == pytest.approx(1 - 2 / (14 / 3))


def features(spark, n=300):
    df = spark.range(n).select(
        "id", F.randn(1).alias("a"), F.randn(2).alias("b"), F.randn(3).alias("c")
    ).withColumn("label", (F.col("a") + 0.3 * F.col("b") > 0).cast("double"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).persist()


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    sums = {r.label: r.s for r in L.with_weights(df).groupBy("label").agg(F.sum("weight").alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_shapley_values_add_up(spark):
    df = features(spark)
    model = L.random_forest(None, 10, 4).fit(df)
    background = X.mean_background(df)
    sums = X.shapley_values(model, df.limit(20), "id", background, 3).groupBy("id").agg(F.sum("contribution").alias("t"))
    from pyspark.ml.functions import array_to_vector

    point = spark.range(1).select(array_to_vector(F.array(*[F.lit(v) for v in background])).alias("features"))
    base = L.scored(model, point).first().score
    for r in L.scored(model, df).join(sums, "id").collect():
        assert r.t == pytest.approx(r.score - base, abs=1e-9)


def test_importances_find_the_strong_feature(spark):
    df = features(spark)
    model = L.logistic_regression(300, weight=None).fit(df)
    out = X.named(X.permutation_importance(model, df, "id"), ["a", "b", "c"]).collect()
    assert max(out, key=lambda r: r.importance).feature == "a"
    linear = X.attribution_summary(X.linear_attributions(list(model.coefficients), df, "id", X.mean_background(df)), ["a", "b", "c"])
    assert linear.first().feature == "a"


def test_folds(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    sizes = stratified_folds(df, "id", "label").groupBy("label", "fold").count().toPandas()
    assert sizes.groupby("label")["count"].agg(lambda c: c.max() - c.min()).max() <= 1
    stamped = df.withColumn("ts", F.timestamp_seconds(F.col("id") * 60))
    blocks = expanding_folds(stamped, "ts", "id", 4).groupBy("block").agg(F.count("*").alias("n"), F.min("id"), F.max("id")).orderBy("block").collect()
    assert [r.n for r in blocks] == [23, 20, 20, 20, 20] and blocks[1][2] == 23


def test_search_samples_different_combinations(spark):
    base = L.boosted_trees()
    grid = S.sampled_grid(base, S.CLASSIFIER_SPACE, 30)
    assert len(grid) == 30 and len({tuple(sorted((p.name, v) for p, v in g.items())) for g in grid}) == 30


def test_cross_validation_runs_on_given_folds(spark):
    df = stratified_folds(features(spark, 200), "id", "label", 3)
    model = S.cross_validate(L.logistic_regression(200, max_iter=10, weight=None), df, folds=3)
    row = S.search_report(model, df).first()
    assert 0.9 < row.mean_score <= 1.0


def test_baselines(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,)], "label double")
    assert L.predict_constant(df, df).first().prediction == 2.0
    assert L.predict_constant(df, df, kind="median").first().prediction == 1.0
    assert L.predict_majority(df, df).first().prediction == 1.0

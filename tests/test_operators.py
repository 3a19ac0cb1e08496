import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.operators import aggregates as A, encode as E, joins as J, profile as P, quality as Q, split as S, targets as T
from shopsight.operators.graphs import connected_components

TS = "order_purchase_timestamp"


def orders(spark, stamps):
    rows = [(i, s) for i, s in enumerate(stamps)]
    return spark.createDataFrame(rows, "order_id long, t string").select("order_id", F.col("t").cast("timestamp").alias(TS))


def test_time_split_breaks_ties_by_id(spark):
    df = orders(spark, ["2024-01-01"] * 4 + ["2023-01-01"] * 4 + [None, None])
    out = {r.order_id: r.split for r in S.assign_time_split(df).collect()}
    assert [i for i, s in out.items() if s == "train"] == [0, 1, 2, 4, 5, 6, 7]
    assert out[3] == "val" and out[8] == out[9] == "test"


def test_time_split_refuses_wrong_ratios(spark):
    with pytest.raises(ValueError):
        S.assign_time_split(orders(spark, ["2024-01-01"]), 0.5, 0.2, 0.2)


def test_splits_partition_the_ids(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    out = S.assign_stratified_split(df, "id", "label")
    counts = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 630, (0, "val"): 135, (0, "test"): 135, (1, "train"): 70, (1, "val"): 15, (1, "test"): 15}
    assert all(r.shared_ids == 0 for r in S.split_overlaps(out, "id").collect())


def test_payments_mode_takes_lowest_on_ties(spark):
    rows = [(1, 1, "b", 2, 5.0), (1, 2, "a", 3, 5.0), (2, 1, None, None, None)]
    df = spark.createDataFrame(rows, "order_id int, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    out = {r.order_id: tuple(r)[1:] for r in J.payments_per_order(df).collect()}
    assert out == {1: (10.0, 3, "a", 2), 2: (0.0, None, None, 1)}


def tables(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "orders": make([(1, 10), (2, 11), (3, 99)], "order_id long, customer_id long"),
        "order_items": make([(1, 1, 7, 5), (1, 2, 8, 5), (2, 1, 7, None)], "order_id long, order_item_id int, product_id long, seller_id long"),
        "products": make([(7, "a"), (8, None)], "product_id long, product_category_name string"),
        "category_translation": make([("a", "A")], "product_category_name string, product_category_name_english string"),
        "customers": make([(10, "x", 1), (11, "y", 2)], "customer_id long, customer_state string, city int"),
        "sellers": make([(5, 3)], "seller_id long, city int"),
        "reviews": make([(1, 4), (1, 2)], "order_id long, review_score int"),
        "payments": make([(1, 1, "card", 1, 9.0)], "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value double"),
    }


def test_merge_keeps_every_order_and_suffixes_clashes(spark):
    out = J.merge_tables(tables(spark))
    assert out.count() == 2 * 2 + 1 + 1 and out.select("order_id").distinct().count() == 3
    assert {"city_customer", "city_seller"} <= set(out.columns)
    steps = {r.table: tuple(r)[2:] for r in J.merge_audit(tables(spark)).collect()}
    assert steps["order_items"] == (3, 4, 1, 1) and steps["reviews"] == (4, 6, 2, 1) and steps["customers"][2] == 1


def test_large_lookups_move_no_order_columns_and_leave_the_rows_by_order(spark, monkeypatch):
    """A lookup too large to broadcast meets the narrow table of its key; nothing is shuffled after the joins by order id."""
    monkeypatch.setattr(J, "sized_lookups", dict)
    broadcast, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"
    before = {c: spark.conf.get(c) for c in (broadcast, adaptive)}
    small = J.merge_tables(tables(spark))
    try:
        spark.conf.set(broadcast, "-1")
        spark.conf.set(adaptive, "false")
        merged = J.merge_tables(tables(spark))
        plan = merged.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(order_id" not in plan.split("SortMergeJoin")[0]
        whole = merged._jdf.queryExecution().executedPlan().toString().splitlines()
        moved = [i for i, line in enumerate(whole) if "Exchange hashpartitioning(product_id" in line]
        assert moved and not any("SortMergeJoin [order_id" in line for line in whole[moved[0] :])
        rows = sorted(map(str, merged.collect()))
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert rows == sorted(map(str, small.collect())) and len(rows) == 6


def test_targets_are_never_null_by_default(spark):
    df = spark.sql("""SELECT cast(null AS int) review_score, cast(null AS timestamp) order_delivered_customer_date,
      timestamp'2024-01-02' order_estimated_delivery_date, timestamp'2024-01-01' order_purchase_timestamp""")
    row = T.add_targets(df).first()
    assert (row.is_satisfied, row.is_late_delivery, row.delivery_days) == (0, 0, None)
    row = T.add_targets(df, null_policy="propagate").first()
    assert row.is_satisfied is None and row.is_late_delivery is None


def test_select_features_refuses_leakage(spark):
    with pytest.raises(ValueError):
        T.select_features(spark.range(1), ["review_score"])


def history(spark):
    rows = [("c", 1, 30.0), ("c", 1, 30.0), ("c", 1, 30.0), ("c", 2, None), ("d", 3, None), (None, 4, 5.0)]
    stamp = F.lit("2024-01-05").cast("timestamp")
    df = spark.createDataFrame(rows, "customer_unique_id string, order_id int, payment_value double")
    return df.withColumn(TS, F.when(F.col("customer_unique_id") == "d", F.lit("2024-01-03 12:00:00").cast("timestamp")).otherwise(stamp))


def test_rfm_counts_items_unless_deduplicated(spark):
    plain = {r.customer_unique_id: r for r in A.rfm(history(spark)).collect()}
    assert set(plain) == {"c", "d"}
    assert (plain["c"].monetary, plain["c"].frequency, plain["c"].recency) == (90.0, 2, 0)
    assert (plain["d"].monetary, plain["d"].recency, plain["d"].avg_order_value) == (0.0, 1, 0.0)
    once = {r.customer_unique_id: r.monetary for r in A.rfm(history(spark), dedup_by="order_id").collect()}
    assert once == {"c": 30.0, "d": 0.0}


def test_category_seen_once_has_unit_deviation(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 3.0), (None, 9.0)], "product_category_name_english string, price double")
    out = {r[0]: r.category_price_std for r in A.category_price_stats(df).collect()}
    assert out == {"a": 1.0, "b": pytest.approx(2**0.5)}


def test_imputer_strategies(spark):
    df = spark.createDataFrame([(1.0, "b", None), (None, "a", 1), (4.0, None, 2), (None, "a", 3)], "x double, s string, y int")
    out = Q.Imputer({"x": ("median", None), "s": ("mode", None), "y": ("drop", None), "z": ("mean", None)}).fit_transform(df)
    assert sorted(tuple(r) for r in out.collect()) == [(2.5, "a", 1), (2.5, "a", 3), (4.0, "a", 2)]
    with pytest.raises(ValueError):
        Q.Imputer({"x": ("guess", None)}).fit(df)


def test_inference_does_not_drop_by_default(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0)], "x double, y double")
    _, model = Q.clean_training(df, check=False, strategies={"y": ("drop", None)}, outlier_columns=["x"])
    assert model.transform(df).count() == 2 and model.transform(df, replay_drop=True).count() == 1


def test_cleaning_model_survives_storage(spark):
    df = spark.createDataFrame([(float(i), None if i % 5 else "a") for i in range(100)], "x double, s string")
    _, model = Q.clean_training(df, check=False, strategies={"x": ("median", None), "s": ("constant", "none")}, outlier_columns=["x"])
    again = Q.CleaningModel.from_table(model.to_table(spark))
    assert again.imputer.fills == {"x": 49.5, "s": "none"} and again.winsorizer.bounds == model.winsorizer.bounds


def test_winsorizer_stays_within_bounds(spark):
    df = spark.range(1000).withColumn("x", F.col("id").cast("double")).unionByName(spark.createDataFrame([(1, None)], "id long, x double"))
    row = Q.winsorize(df, "x").agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert tuple(row) == (pytest.approx(9.99), pytest.approx(989.01), 1000)


def test_validation_reports_every_failure(spark):
    df = spark.createDataFrame([("a", -1.0), (None, 7.0)], "k string, v double")
    with pytest.raises(Q.ValidationError) as caught:
        Q.validate(df, [Q.Rule("k", "string", nullable=False), Q.Rule("v", "number", low=0, high=5), Q.Rule("w")])
    assert {(c, k) for c, k, _, _ in caught.value.failures} == {("k", "not_null"), ("v", "at_least"), ("v", "at_most"), ("w", "present")}
    assert Q.validate(df, [Q.Rule("v", "number")])


def test_rejects_carry_reasons(spark):
    df = spark.createDataFrame([("a", 1.0), (None, -1.0)], "k string, v double")
    valid, rejected = Q.split_valid(df, [Q.Rule("k", nullable=False), Q.Rule("v", low=0)])
    assert valid.count() == 1 and rejected.first().reasons == ["k:not_null", "v:at_least"]


@pytest.mark.parametrize("rows_per_range", [50, 1_000_000])
def test_forward_fill(spark, rows_per_range):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("p"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    out = Q.forward_fill(df, ["p"], ["id"], ["v"], rows_per_range).toPandas().sort_values("id")
    expected = df.toPandas().sort_values("id").groupby("p").v.ffill()
    pd.testing.assert_series_equal(out.v.reset_index(drop=True), expected.reset_index(drop=True), check_names=False)


def test_drop_repeats_keeps_first(spark):
    df = spark.createDataFrame([(1, 5, "z"), (1, 3, "y"), (2, 1, "x")], "k int, o int, v string")
    assert sorted(tuple(r) for r in Q.drop_repeats(df, ["k"], ["o"]).collect()) == [(1, 3, "y"), (2, 1, "x")]


def test_moments_match_pandas(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 2.5, 9.0, 30.0)], "x double")
    row = df.agg(P.corrected_skewness(F.col("x")), P.corrected_kurtosis(F.col("x"))).first()
    series = pd.Series([1.0, 2.0, 2.5, 9.0, 30.0])
    assert tuple(row) == pytest.approx((series.skew(), series.kurtosis()))


def test_profiles_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert tuple(P.basic_stats(empty).first()) == (0, 2, 0, 0, None)
    assert {r.suggested_strategy for r in P.missing_values(empty).collect()} == {"none"}
    assert P.class_balance(empty, "a").first().total_samples is None
    assert P.regression_target(empty, "a").first().total_samples == 0


def test_regression_target_sets_infinities_aside(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,), (None,)], "x double")
    row = P.regression_target(df, "x").first()
    assert (row.total_samples, row.null_count, row["max"], row.median) == (2, 1, 2.0, 1.5)


def test_scaler_centres_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    out = E.StandardScaler(["x", "c"]).fit_transform(df).agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert tuple(out) == pytest.approx((0.0, 1.0, 0.0))


def test_unseen_level_is_all_zero_and_pipeline_is_savable(spark, tmp_path):
    from pyspark.ml import PipelineModel

    train = spark.createDataFrame([(1.0, "a", 1), (2.0, "b", 0), (4.0, None, 1)], "x double, s string, f int")
    model = E.fit_preprocessor(train, ["x"], ["s"], ["f"])
    assert E.feature_names(model, train) == ["x", "s_a", "s_b", "s_unknown", "f"]
    model.write().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep"))
    rows = [list(r.features) for r in again.transform(spark.createDataFrame([(2.0, "z", 0), (2.0, None, 1)], train.schema)).collect()]
    assert rows[0][1:] == [0.0, 0.0, 0.0, 0.0] and rows[1][1:] == [0.0, 0.0, 1.0, 1.0]


def test_one_hot_rows_sum_to_at_most_one(spark):
    train = spark.createDataFrame([("a",), (None,)], "s string")
    out = E.OneHot(["s"]).fit(train).transform(spark.createDataFrame([("a",), ("q",), (None,)], "s string"))
    assert [(r.s_a, r.s_unknown) for r in out.collect()] == [(1, 0), (0, 0), (0, 1)]


def test_correlation_filter_drops_later_column(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), F.rand(1).alias("c"))
    out, dropped = E.drop_correlated(df, ["a", "b", "c"])
    assert dropped == ["b"] and out.columns == ["a", "c"]


def test_quantile_uniform_is_monotone(spark):
    df = spark.range(500).withColumn("x", F.floor(F.col("id") / 7).cast("double"))
    pdf = E.quantile_uniform(df, "x", "u").toPandas().sort_values("x")
    assert pdf.u.is_monotonic_increasing and pdf.u.between(0, 1).all()


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 30)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(chain + star + [(40, 40)], "u long, v long")).collect()}
    assert set(out.values()) == {100, 5} and all(out[i] == 100 for i in range(100, 161)) and all(out[i] == 5 for i in range(5, 30))


def test_histogram_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), (None, 1.0), (None, None)], "g string, x double")
    got = {(r.g, r.bin): (r.n, r.density) for r in P.histogram(df, "x", 2, by=["g"]).collect()}
    assert got == {("a", 0): (1, 1.0), ("a", 1): (1, 1.0), (None, 1): (1, 2.0)}


def test_customers_orders_are_counted_without_a_mode_per_order(spark):
    rows = [
        (1, 10, 5.0, "b"), (1, 10, 5.0, "a"), (1, 11, 1.0, "b"), (1, 11, 1.0, "a"), (1, None, 2.0, None), (1, None, 2.0, None),
        (2, 10, 7.0, None), (3, None, 1.0, "z"), (None, 12, 1.0, "z"),
    ]
    df = spark.createDataFrame(rows, "customer_unique_id long, order_id long, payment_value double, product_category_name_english string")
    more = {TS: F.lit("2024-01-01").cast("timestamp"), "order_item_id": F.lit(1), "is_late_delivery": F.lit(0)}
    df = df.withColumns({**more, **{c: F.lit(1.0) for c in ("review_score", "delivery_days", "price")}})
    table = A.customer_behaviour(df, "2024-01-03", fills={})
    got = {r.customer_unique_id: (r.frequency, r.monetary, r.total_items, r.favorite_category) for r in table.collect()}
    assert got == {1: (2, 16.0, 6, "a"), 2: (1, 7.0, 1, "unknown"), 3: (0, 1.0, 1, "z")}
    plan = table._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2

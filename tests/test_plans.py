import pytest
from pyspark.sql import functions as F

import catalog
from shopsight.cluster import kmeans, models
from shopsight.learn.models import decision_tree
from shopsight.operators.aggregates import customer_behaviour
from shopsight.operators.joins import merge_tables
from shopsight.operators.quality import DEFAULT_RULES, CleaningModel, Rule
from shopsight.operators.targets import add_targets
from shopsight.plans import segmentation
from shopsight.plans.features import BINARY_FEATURES, CATEGORICAL_FEATURES, NUMERICAL_FEATURES, FeatureModel, save_features
from shopsight.plans.preparation import prepare, save_prepared
from shopsight.plans.satisfaction import SATISFACTION_NUMERIC, train_classifiers
from shopsight.plans.segmentation import main, with_numeric_id
from shopsight.sources import bindings
from shopsight.sources.readers import mean_coordinates, read_raw_tables, read_split
from shopsight.sources.writers import write_table
from shopsight.streaming.drift import bin_edges, serving_skew, window_histograms
from shopsight.streaming.scoring import sampled_log


@pytest.fixture(scope="module")
def prepared(spark, small):
    tables = bindings.canonical_tables(spark, small)
    rules = [r for r in DEFAULT_RULES if r.column not in ("order_id", "customer_id")]
    return prepare(tables, rules=rules)


def test_preparation_keeps_orders_and_uses_train_parameters(spark, small, prepared, tmp_path):
    orders = bindings.orders(spark, small)
    assert prepared.data.select("order_id").distinct().count() == orders.count()
    assert prepared.data.groupBy("order_id").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    low, high = prepared.model.winsorizer.bounds["price"]
    row = prepared.part("test").agg(F.min("price"), F.max("price")).first()
    assert low <= row[0] and row[1] <= high
    save_prepared(prepared, str(tmp_path))
    assert read_split(spark, f"{tmp_path}/splits", "val").count() == prepared.part("val").count()
    stored = CleaningModel.from_table(spark.read.json(f"{tmp_path}/cleaning"))
    assert stored.winsorizer.bounds["price"] == pytest.approx((low, high))


def test_raw_input_to_prediction(spark, small, prepared, tmp_path):
    model = FeatureModel(mean_coordinates(bindings.geolocation(spark, small)), bindings.lexicon(spark, small))
    model.fit(prepared.part("train"))
    featured = model.transform(prepared.data).persist()
    assert featured.count() == prepared.data.count()
    assert set(NUMERICAL_FEATURES + CATEGORICAL_FEATURES + BINARY_FEATURES) <= set(featured.columns)
    customers = model.customers.agg(F.min("recency"), F.min("frequency")).first()
    assert customers[0] >= 0 and customers[1] >= 1
    # A customer unseen in training gets the median of the training customers.
    assert featured.where(F.col("recency").isNull()).count() == 0
    save_features(model, featured, str(tmp_path))
    train, val = featured.where("split = 'train'"), featured.where("split = 'val'")
    trained = train_classifiers(
        train, val, SATISFACTION_NUMERIC, CATEGORICAL_FEATURES, BINARY_FEATURES, estimators={"tree": decision_tree(depth=3)}
    )
    rows = trained.full_model("tree").transform(val).select("prediction").distinct().collect()
    assert {r.prediction for r in rows} <= {0.0, 1.0}
    assert trained.comparison.where("name = 'Baseline'").first().roc_auc == 0.5


def test_segmentation_fits_each_kind_of_model_once(spark, small, monkeypatch):
    calls = []
    lloyd, mixtures = kmeans.lloyd, models.fit_mixtures
    monkeypatch.setattr(kmeans, "lloyd", lambda *a: calls.append("centres") or lloyd(*a))
    for place in (models, segmentation):
        monkeypatch.setattr(place, "fit_mixtures", lambda *a: calls.append("mixtures") or mixtures(*a), raising=False)
    customers = customer_behaviour(add_targets(merge_tables(bindings.canonical_tables(spark, small)))).persist()
    found = segmentation.segment_customers(customers, k=3, ks=[2, 4], restarts=2, mixture_restarts=1)
    assert sorted(calls) == ["centres", "mixtures"]
    assert found.model.k == 3 and [r.k for r in found.sweep.sort("k").collect()] == [2, 4] and [r.n for r in found.mixtures.sort("n").collect()] == [2, 4]


def test_segmentation_job(spark, small, tmp_path):
    from catalog.base import wide

    write_table(customer_behaviour(wide(spark, small)), f"{tmp_path}/customers")
    main(["--input", f"{tmp_path}/customers", "--output", f"{tmp_path}/out", "--k", "3", "--k-min", "3", "--k-max", "3"])
    out = spark.read.parquet(f"{tmp_path}/out/customers")
    assert out.count() == 150 and out.select("cluster_id", "customer_segment").distinct().count() == 3
    comparison = spark.read.option("header", True).csv(f"{tmp_path}/out/comparison")
    assert {r.name for r in comparison.collect()} == {"K-Means", "DBSCAN", "Hierarchical", "GMM"}


@pytest.mark.parametrize("as_text", [True, False])
def test_rows_have_numbers_of_their_own(spark, as_text):
    ids = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("key") if as_text else F.col("id").alias("key"))
    numbered, again = (with_numeric_id(ids, "key") for _ in range(2))
    assert numbered.select("_row").distinct().count() == 5000
    assert numbered.join(again, ["key", "_row"]).count() == 5000


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="orders"):
        read_raw_tables(spark, {"orders": f"{tmp_path}/none.csv"})


def test_bad_dates_become_null(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at\na,b,new,2024-01-01 10:00:00,soon\n")
    row = read_raw_tables(spark, {"orders": str(path)})["orders"].first()
    assert row.order_purchase_timestamp.hour == 10 and row.order_approved_at is None


def test_same_distribution_has_no_skew(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("double").alias("price"))
    same = serving_skew(df, df, ["price"]).first()
    assert same.js == pytest.approx(0.0) and not same.alert
    moved = serving_skew(df, df.withColumn("price", F.col("price") + 40), ["price"]).first()
    assert moved.js > 0.2 and moved.alert


def test_late_rows_are_not_counted(spark, tmp_path):
    def put(name, rows):
        df = spark.createDataFrame(rows, "t string, v double").select(F.col("t").cast("timestamp").alias("ts"), "v")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    put("first", [("2024-01-01 00:10:00", 1.0), ("2024-01-01 03:00:00", 2.0)])
    static = spark.read.parquet(f"{tmp_path}/in")
    edges = bin_edges(static, ["v"])

    def run():
        stream = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = (
            window_histograms(stream, "ts", edges, "1 hour", "10 minutes")
            .writeStream.format("parquet")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    run()
    put("late", [("2024-01-01 00:20:00", 1.0), ("2024-01-01 05:00:00", 2.0)])
    run()
    put("end", [("2024-01-01 09:00:00", 2.0)])
    run()
    out = spark.read.parquet(f"{tmp_path}/out").groupBy("window_start").agg(F.sum("n").alias("n")).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.n) for r in out] == [(0, 1), (3, 1), (5, 1)]


def test_sampled_log_is_stable(spark):
    df = spark.range(20_000)
    once, again = (sampled_log(df, "id", 0.1).count() for _ in range(2))
    assert once == again and 1800 < once < 2200
    assert sampled_log(df, "id", 1.0).count() == 20_000


def test_rules_are_plain_data():
    assert Rule("x", low=0) == Rule("x", low=0)


@pytest.mark.parametrize("name", ["c4_group_statistics", "f7_product_features", "d19_seller_history", "q3_iqr_outliers"])
def test_queries_that_read_the_wide_frame_again_read_a_kept_one(spark, small, name):
    """Kept columns show their physical plan, with file scans; a relation of order items would be read anew."""
    plan = catalog.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" in plan and "FileScan parquet [l_orderkey" in plan and "Relation [l_orderkey" not in plan


def test_feature_frame_joins_the_tables_once(spark, small):
    """The fit and the frame read kept columns, in which no text is repeated for the items of an order."""
    plan = catalog.QUERIES["f15_feature_frame"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in plan.splitlines() if "InMemoryRelation" in line and "freight_value" in line]
    assert kept and not any("review_comment_message" in line for line in kept)
    assert "FileScan parquet [l_orderkey" in plan and "Relation [l_orderkey" not in plan

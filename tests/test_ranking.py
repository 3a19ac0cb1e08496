import numpy as np
import pytest
from pyspark.sql import functions as F

from shopsight.operators import ranking as R
from shopsight.operators.encode import target_encoded
from shopsight.operators.quality import forward_fill


def frame(spark, n=5000, heavy=True):
    """A third of the rows share one value."""
    df = spark.range(n).withColumn("x", F.round(F.rand(3) * 1000, 2))
    return df.withColumn("x", F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.col("x"))) if heavy else df


@pytest.mark.parametrize("buffer_values", [50, 100_000])
def test_order_statistics(spark, buffer_values):
    df = frame(spark).persist()
    values = sorted(r.x for r in df.collect())
    ranks = [0, 1, 700, 2499, 2500, 4000, 4999]
    got = R.order_statistics(df, "x", ranks, buffer_values)
    assert {r: v for r, (v, _) in got.items()} == {r: values[r] for r in ranks}
    assert all(before == sum(v < got[r][0] for v in values) for r, (_, before) in got.items())


def test_order_statistics_of_text(spark):
    df = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("s")).persist()
    values = sorted(r.s for r in df.collect())
    got = R.order_statistics(df, "s", [5, 1500, 2990], 100)
    assert {r: v for r, (v, _) in got.items()} == {r: values[r] for r in (5, 1500, 2990)}


def test_order_statistics_edges(spark):
    empty = spark.createDataFrame([], "x double")
    assert R.order_statistics(empty, "x", [0, 3]) == {}
    nulls = spark.createDataFrame([(None,), (2.0,), (1.0,)], "x double")
    assert R.order_statistics(nulls, "x", [0, 1, 2]) == {0: (1.0, 0), 1: (2.0, 1)}


@pytest.mark.parametrize("buffer_values", [100, 1_000_000])
def test_quantiles_match_numpy(spark, buffer_values):
    df = frame(spark, heavy=False).persist()
    values = [r.x for r in df.collect()]
    probs = [0.0, 0.01, 0.25, 0.5, 0.953, 1.0]
    row = R.quantile_table(df, ["x"], probs, buffer_values=buffer_values).first()
    assert row.q == pytest.approx(list(np.quantile(values, probs)))


@pytest.mark.parametrize("buffer_values", [2, 100, 1_000_000])
def test_many_quantiles_given_as_numpy_numbers(spark, buffer_values):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    df = frame(spark).select("x").unionByName(spark.createDataFrame(rows, "x double")).persist()
    values = sorted((r.x for r in df.where("x is not null").collect()), key=lambda v: (v != v, v))
    probs = np.arange(0, len(values), 13) / (len(values) - 1)
    row = R.quantile_table(df, ["x"], probs, buffer_values=buffer_values).first()
    assert row.q[1:-1] == pytest.approx([values[i] for i in range(0, len(values), 13)][1:-1])
    ranks = list(range(0, len(values), 50)) + [len(values) - 1]
    got = R.order_statistics(df, "x", ranks, buffer_values)
    assert repr([got[r][0] for r in ranks]) == repr([values[r] for r in ranks])
    assert all(values[before] == v or v != v for v, before in got.values()) and got[len(values) - 1][1] == len(values) - 1


@pytest.mark.parametrize("buffer_values", [100, 1_000_000])
def test_grouped_quantiles(spark, buffer_values):
    df = frame(spark, 600).withColumn("g", F.when(F.col("id") < 550, 1)).persist()
    pdf = df.toPandas()
    got = {r.g: r.q[0] for r in R.quantile_table(df, ["x"], [0.5], ["g"], buffer_values).collect()}
    assert got[1] == pytest.approx(pdf[pdf.g == 1].x.median()) and got[None] == pytest.approx(pdf[pdf.g.isna()].x.median())


def test_all_null_quantile(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert R.medians(df, ["x"]) == {"x": None}


@pytest.mark.parametrize("rows_per_range", [200, 1_000_000])
@pytest.mark.parametrize("descending", [False, True])
def test_global_rank_with_a_heavy_value(spark, rows_per_range, descending):
    df = frame(spark).persist()
    out = R.global_rank(df, ["x", "id"], "k", descending=descending, rows_per_range=rows_per_range).collect()
    expected = sorted(((r.x, r.id) for r in df.collect()), reverse=descending)
    assert [(r.x, r.id) for r in sorted(out, key=lambda r: r.k)] == expected
    assert sorted(r.k for r in out) == list(range(1, 5001))


def test_heavy_value_is_spread(spark):
    """Rows sharing one value do not end up in one range."""
    df = frame(spark)
    plan = R.global_rank(df, ["x", "id"], "k", rows_per_range=200)
    assert "_r2" in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows_per_range", [100, 1_000_000])
def test_running_totals_within_groups(spark, rows_per_range):
    df = frame(spark, 2000).withColumn("g", F.col("id") % 3).persist()
    out = R.running_totals(df, ["x", "id"], {"t": "id"}, ["g"], rows_per_range=rows_per_range).toPandas()
    out = out.sort_values(["g", "x", "id"])
    assert (out.groupby("g").id.cumsum() == out.t).all()


def test_a_rank_between_two_heavy_values_is_found(spark):
    rows = [(0.0,)] * 10_000 + [(0.1 + i / 10,) for i in range(6)] + [(1.0,)] * 10_000
    df = spark.createDataFrame(rows, "x double").repartition(4)
    ordered = sorted(r[0] for r in rows)
    ranks = [0, 9_999, 10_000, 10_002, 10_005, 10_006, 20_005]
    got = R.order_statistics(df, "x", ranks, buffer_values=3)
    assert got == {r: (ordered[r], ordered.index(ordered[r])) for r in ranks}


@pytest.mark.parametrize("rows_per_range", [10, 1_000_000])
def test_null_groups_are_groups(spark, rows_per_range):
    rows = [(i, None if i % 3 == 0 else f"g{i % 3}", float((i * 37) % 101)) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    out = R.global_rank(df, ["x", "id"], "k", within=["g"], rows_per_range=rows_per_range).collect()
    for group in (None, "g1", "g2"):
        mine = sorted((r for r in out if r.g == group), key=lambda r: (r.x, r.id))
        assert [r.k for r in mine] == list(range(1, 51))


@pytest.mark.parametrize("rows_per_range", [10, 1_000_000])
def test_null_partitions_are_filled(spark, rows_per_range):
    rows = [(i, None if i % 2 else "p", float(i) if i < 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, p string, v double")
    assert {(r.id, r.v) for r in forward_fill(df, ["p"], ["id"], ["v"], rows_per_range).collect()} == {(i, float(i % 2)) for i in range(100)}


def test_a_null_level_is_encoded_by_what_training_shows(spark):
    train = spark.createDataFrame([(None, 1.0), (None, 1.0), ("a", 0.0), ("a", 0.0)], "c string, y double")
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "new")], "id int, c string")
    out = {r.id: r.c_target for r in target_encoded(train, df, "c", "y", smoothing=0.0).collect()}
    assert out == {1: 1.0, 2: 0.0, 3: 0.5}

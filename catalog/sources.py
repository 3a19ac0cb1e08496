"""Sources and sinks: each query writes with the library and reads back."""

from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide
from shopsight.operators.aggregates import category_price_stats, customer_behaviour, rfm
from shopsight.operators.profile import basic_stats, class_balance, regression_target
from shopsight.operators.quality import CleaningModel, clean_training
from shopsight.operators.split import assign_time_split
from shopsight.operators.targets import add_targets
from shopsight.session import scratch_uri
from shopsight.sources import bindings
from shopsight.sources.readers import (
    lenient_timestamp,
    mean_coordinates,
    read_parquet_table,
    read_raw_tables,
    read_split,
)
from shopsight.sources.writers import (
    read_metadata,
    read_split_ids,
    write_metadata,
    write_report,
    write_split_ids,
    write_splits,
    write_table,
)


@query(
    "a1_load_tables",
    W + """SELECT 'customers' AS name, count(*) AS n, count(DISTINCT customer_state) AS states FROM customers_c
    UNION ALL SELECT 'sellers', count(*), count(DISTINCT seller_state) FROM sellers_c""",
)
def load_tables(spark, sf):
    uri = scratch_uri(spark, "raw")
    files = {}
    for name in ("customers", "sellers"):
        write_table(getattr(bindings, name)(spark, sf), f"{uri}/{name}", "csv")
        files[name] = f"{uri}/{name}"
    loaded = read_raw_tables(spark, files)
    parts = [
        loaded[n].agg(F.count("*").alias("n"), F.count_distinct(c).alias("states")).select(F.lit(n).alias("name"), "*")
        for n, c in (("customers", "customer_state"), ("sellers", "seller_state"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "a2_parse_dates",
    """SELECT o_orderkey AS order_id,
      CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""",
)
def parse_dates(spark, sf):
    raw = bindings.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 13 == 0, "not a date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("text"),
    )
    return raw.select("order_id", F.date_format(lenient_timestamp("text"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "a3_geolocation",
    W + "SELECT zip AS geolocation_zip_code_prefix, round(lat, 4) AS geolocation_lat, round(lng, 4) AS geolocation_lng FROM geo_c",
)
def geolocation(spark, sf):
    return rounded(mean_coordinates(bindings.geolocation(spark, sf)))


_CUTS = """, n AS (SELECT count(*) AS n FROM orders), ranked AS (
  SELECT o_orderkey AS order_id, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS k FROM orders),
split AS (SELECT order_id, o_totalprice, CASE WHEN k < floor((SELECT n FROM n) * 0.7::DOUBLE) THEN 'train'
  WHEN k < floor((SELECT n FROM n) * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM ranked)
"""


def _split_orders(spark, sf):
    orders = bindings.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"), "o_totalprice"
    )
    return assign_time_split(orders, ts="ts")


@query("a4_split_parquet", W + _CUTS + "SELECT order_id, round(o_totalprice, 4) AS o_totalprice FROM split WHERE split = 'val'")
def split_parquet(spark, sf):
    uri = scratch_uri(spark, "splits")
    write_splits(_split_orders(spark, sf), uri)
    return rounded(read_split(spark, uri, "val").select("order_id", "o_totalprice"))


@query("a5_split_ids", W + _CUTS + "SELECT order_id, split FROM split")
def split_ids(spark, sf):
    uri = scratch_uri(spark, "ids")
    write_split_ids(_split_orders(spark, sf), "order_id", uri)
    return read_split_ids(spark, uri).select("order_id", "split")


_CLEANING = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@query(
    "a6_cleaning_parameters",
    W
    + ", filled AS (SELECT "
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM products_c)) AS {c}" for c in _CLEANING)
    + " FROM products_c) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", 'median' AS strategy,
        round((SELECT quantile_cont({c}, 0.5) FROM products_c), 4) AS fill_number, NULL::VARCHAR AS fill_text,
        round(quantile_cont({c}, 0.01), 4) AS low, round(quantile_cont({c}, 0.99), 4) AS high FROM filled"""
        for c in _CLEANING
    ),
)
def cleaning_parameters(spark, sf):
    strategies = {c: ("median", None) for c in _CLEANING}
    _, model = clean_training(
        bindings.products(spark, sf), check=False, strategies=strategies, outlier_columns=_CLEANING
    )
    uri = scratch_uri(spark, "cleaning")
    write_table(model.to_table(spark), uri, "json")
    schema = model.to_table(spark).schema
    stored = CleaningModel.from_table(spark.read.schema(schema).json(uri))
    return rounded(stored.to_table(spark))


@query(
    "a7_feature_artifacts",
    W
    + """SELECT product_category_name_english, round(avg(price), 4) AS category_price_mean,
    round(coalesce(stddev_samp(price), 1.0), 4) AS category_price_std
    FROM tw WHERE product_category_name_english IS NOT NULL GROUP BY 1""",
)
def feature_artifacts(spark, sf):
    uri = scratch_uri(spark, "stats")
    write_table(category_price_stats(wide(spark, sf)), uri, "csv")
    schema = "product_category_name_english string, category_price_mean double, category_price_std double"
    return rounded(spark.read.schema(schema).option("header", True).csv(uri))


@query(
    "a9_customer_parquet",
    W + "SELECT customer_unique_id, recency, frequency, " + r("monetary") + " FROM cust",
)
def customer_parquet(spark, sf):
    uri = scratch_uri(spark, "customers")
    write_table(customer_behaviour(wide(spark, sf)), uri)
    return rounded(read_parquet_table(spark, uri, ["customer_unique_id", "recency", "frequency", "monetary"]))


@query("a10_profile_report")
def profile_report(spark, sf):
    df = add_targets(bindings.orders(spark, sf).join(bindings.reviews(spark, sf), "order_id", "left"))
    uri = scratch_uri(spark, "report")
    write_report(
        {
            "basic": basic_stats(df.drop("review_comment_message")),
            "target": class_balance(df),
            "delivery": regression_target(df),
        },
        uri,
    )
    return spark.read.schema("report string, item string, metric string, value string").json(uri)


@query("a11_run_metadata")
def run_metadata(spark, sf):
    table = rfm(bindings.orders(spark, sf).join(bindings.payments(spark, sf), "order_id", "left").withColumnRenamed("customer_id", "customer_unique_id"))
    facts = table.agg(F.count("*").alias("customers"), F.round(F.avg("frequency"), 4).alias("mean_frequency")).first()
    uri = scratch_uri(spark, "metadata")
    write_metadata(spark, facts.asDict(), uri)
    back = read_metadata(spark, uri)
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(back.items())], "key string, value string")

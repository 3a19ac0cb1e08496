"""The order-centred tables as views over the star-schema test tables.

Columns the test tables lack are derived from keys, with gaps at fixed keys, so that missing values,
orders without items, undelivered orders and unreviewed orders all occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopsight.functions.geo import REGION_STATES
from shopsight.sources.readers import read_parquet_table

STATES = [s for states in REGION_STATES.values() for s in states]
DAY = 86_400


# Declared layouts: opening a table costs no job to read its footer.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, f"{sf_dir}/{name}.parquet", schema=LAYOUTS.get(name))


def _plus_seconds(ts: str, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * F.lit(1_000_000))


def _state(nation: str) -> Column:
    """One code per nation; nation 23 has a code outside every region, nation 24 none."""
    codes = F.array(*[F.lit(s) for s in STATES[:23]], F.lit("zz"))
    return F.get(codes, F.col(nation))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    base = table(spark, sf_dir, "orders").withColumn("bought", _plus_seconds("o_orderdate", k * 37 % 1440 * 60))
    delivered = _plus_seconds("bought", (k * 7 % 40 + 5) * DAY + k % 24 * 3600)
    status = F.col("o_orderstatus")
    return base.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("processing").alias("order_status"),
        F.col("bought").alias("order_purchase_timestamp"),
        F.when(k % 31 != 0, delivered).alias("order_delivered_customer_date"),
        _plus_seconds("bought", F.lit(30 * DAY)).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("product_id"),
        F.when(k % 23 != 0, F.col("p_brand")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.col("p_retailprice").cast("int").alias("product_description_lenght"),
        F.when(k % 29 != 0, k % 6 + 1).cast("int").alias("product_photos_qty"),
        F.when(k % 17 != 0, F.col("p_size") * F.lit(100.0)).alias("product_weight_g"),
        (F.col("p_size") + F.lit(10.0)).alias("product_length_cm"),
        (k % 30 + F.lit(2.0)).alias("product_height_cm"),
        (k % 20 + F.lit(5.0)).alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        name.alias("product_category_name"),
        F.replace(name, F.lit("Brand#"), F.lit("category_")).alias("product_category_name_english"),
    ).distinct()


def _places(spark: SparkSession, sf_dir: str, source: str, letter: str, role: str, keys: dict[str, str]) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    nation = f"{letter}_nationkey"
    return table(spark, sf_dir, source).join(nations, F.col(nation) == F.col("n_nationkey"), "left").select(
        *[F.col(c).alias(n) for n, c in keys.items()],
        F.col(nation).alias(f"{role}_zip_code_prefix"),
        F.col("n_name").alias(f"{role}_city"),
        _state(nation).alias(f"{role}_state"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"customer_id": "c_custkey", "customer_unique_id": "c_custkey"}
    return _places(spark, sf_dir, "customer", "c", "customer", keys)


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir, "supplier", "s", "seller", {"seller_id": "s_suppkey"})


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (e - e % 2).alias("order_id"),
        (e % 2 + 1).cast("int").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (F.get_json_object("props", "$.k").cast("int") % 12 + 1).alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("o_orderkey"), F.col("text").alias("review_comment_message")
    )
    scored = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 41 != 0)
    return scored.join(texts, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        "review_comment_message",
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per zip prefix, one per customer there; prefix 22 has none."""
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(n != 22).select(
        n.alias("geolocation_zip_code_prefix"),
        (n * F.lit(3.0) - 36 + k % 10 * F.lit(0.01)).alias("geolocation_lat"),
        (n * F.lit(7.0) - 84 + k % 7 * F.lit(0.01)).alias("geolocation_lng"),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark texts, scored from their length."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    ).where(F.col("word") != "").distinct()
    size = F.length("word")
    return words.select("word", ((size % 5 - 2) / F.lit(2.0)).alias("polarity"), (size % 3 / F.lit(2.0)).alias("subjectivity"))


def canonical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    makers = (orders, order_items, products, category_translation, customers, sellers, payments, reviews)
    return {m.__name__: m(spark, sf_dir) for m in makers}

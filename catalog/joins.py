"""Joins."""

from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide, wide_kept
from shopsight.operators.aggregates import category_price_stats, rfm
from shopsight.operators.joins import (
    attach_coordinates,
    attach_segments,
    attach_with_fill,
    left_join,
    map_labels,
    merge_audit,
    merge_tables,
    orphan_counts,
)
from shopsight.operators.ranking import medians
from shopsight.sources import bindings
from shopsight.sources.readers import mean_coordinates

_WIDE = [
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "customer_id",
    "order_status",
    "price",
    "freight_value",
    "product_category_name_english",
    "product_weight_g",
    "customer_state",
    "seller_city",
    "review_score",
    "payment_value",
    "payment_installments",
    "payment_type",
    "payment_methods_count",
]


@query(
    "c1_merge_tables",
    W
    + f"SELECT {', '.join(c for c in _WIDE if c not in ('price', 'freight_value', 'product_weight_g', 'payment_value'))}, "
    + r("price", "freight_value", "product_weight_g", "payment_value")
    + " FROM wide",
)
def merged(spark, sf):
    return rounded(merge_tables(bindings.canonical_tables(spark, sf)).select(*_WIDE))


@query(
    "c2_suffixes",
    """SELECT c.c_custkey AS k, c.c_nationkey AS nationkey_customer, round(c.c_acctbal, 4) AS acctbal_customer,
      s.s_nationkey AS nationkey_seller, round(s.s_acctbal, 4) AS acctbal_seller
    FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""",
)
def suffixes(spark, sf):
    left = bindings.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal")
    )
    right = bindings.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    return rounded(left_join(left, right, "k", ("_customer", "_seller")))


@query(
    "c3_two_roles",
    W
    + """SELECT order_id, order_item_id, price, round(c.lat, 4) AS customer_lat, round(c.lng, 4) AS customer_lng,
      round(s.lat, 4) AS seller_lat, round(s.lng, 4) AS seller_lng
    FROM wide LEFT JOIN geo_c c ON customer_zip_code_prefix = c.zip LEFT JOIN geo_c s ON seller_zip_code_prefix = s.zip""",
)
def two_roles(spark, sf):
    geo = mean_coordinates(bindings.geolocation(spark, sf))
    names = ["order_id", "order_item_id", "price", "customer_lat", "customer_lng", "seller_lat", "seller_lng"]
    return rounded(attach_coordinates(merge_tables(bindings.canonical_tables(spark, sf)), geo).select(*names))


@query(
    "c4_group_statistics",
    W
    + """SELECT order_id, order_item_id, t.price, round(coalesce(m, (SELECT avg(price) FROM tw)), 4) AS category_price_mean
    FROM tw t LEFT JOIN (SELECT product_category_name_english AS c, avg(price) AS m FROM tw WHERE c IS NOT NULL GROUP BY 1) s
      ON t.product_category_name_english = s.c""",
)
def group_statistics(spark, sf):
    df = wide_kept(spark, sf, "order_id", "order_item_id", "price", "product_category_name_english")
    mean = df.agg(F.avg("price")).first()[0]
    out = attach_with_fill(df, category_price_stats(df), "product_category_name_english", {"category_price_mean": mean})
    return rounded(out.select("order_id", "order_item_id", "price", "category_price_mean"))


_HALF = """, early AS (SELECT * FROM tw WHERE order_purchase_timestamp < TIMESTAMP '1996-01-01'),
e AS (SELECT customer_unique_id, count(DISTINCT order_id) AS frequency, coalesce(sum(payment_value), 0.0::DOUBLE) AS monetary
  FROM early GROUP BY 1)
"""


def _early_customers(spark, sf):
    df = wide(spark, sf)
    return df, rfm(df.where(F.col("order_purchase_timestamp") < F.lit("1996-01-01").cast("timestamp")))


@query(
    "c5_customer_features",
    W
    + _HALF
    + """SELECT order_id, order_item_id, price,
      round(coalesce(frequency, (SELECT quantile_cont(frequency, 0.5) FROM e)), 4) AS frequency,
      round(coalesce(monetary, (SELECT quantile_cont(monetary, 0.5) FROM e)), 4) AS monetary
    FROM tw LEFT JOIN e USING (customer_unique_id)""",
)
def customer_features(spark, sf):
    df, customers = _early_customers(spark, sf)
    fills = medians(customers, ["frequency", "monetary"])
    out = attach_with_fill(df, customers, "customer_unique_id", fills)
    return rounded(out.select("order_id", "order_item_id", "price", "frequency", "monetary"))


@query(
    "c6_segments",
    W
    + _HALF
    + """SELECT order_id, order_item_id, price, CAST(coalesce(frequency % 4, -1) AS INT) AS cluster_id,
      CASE WHEN frequency IS NULL THEN 'new_customer' ELSE 'segment_' || (frequency % 4) END AS customer_segment
    FROM tw LEFT JOIN e USING (customer_unique_id)""",
)
def segments(spark, sf):
    df, customers = _early_customers(spark, sf)
    cluster = (F.col("frequency") % 4).cast("int")
    labelled = customers.withColumn("cluster_id", cluster).withColumn(
        "customer_segment", F.concat(F.lit("segment_"), F.col("cluster_id").cast("string"))
    )
    out = attach_segments(df, labelled)
    return out.select("order_id", "order_item_id", "price", "cluster_id", "customer_segment")


@query(
    "c7_label_map",
    "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def label_map(spark, sf):
    nations = bindings.table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return map_labels(bindings.table(spark, sf, "customer"), nations, "c_nationkey", "n_name").select("c_custkey", "n_name")


@query(
    "c10_merge_audit",
    W
    + """, s1 AS (SELECT order_id, items_c.product_id, customer_id, seller_id FROM orders_c LEFT JOIN items_c USING (order_id)),
    steps AS (
      SELECT 1 AS step, 'order_items' AS "table", order_id AS key, 'o' AS side, count(*) AS n FROM orders_c GROUP BY order_id
      UNION ALL SELECT 2, 'products', product_id, 'o', count(*) FROM s1 GROUP BY product_id
      UNION ALL SELECT 3, 'customers', customer_id, 'o', count(*) FROM s1 GROUP BY customer_id
      UNION ALL SELECT 4, 'sellers', seller_id, 'o', count(*) FROM s1 GROUP BY seller_id
      UNION ALL SELECT 5, 'reviews', order_id, 'o', count(*) FROM s1 GROUP BY order_id
      UNION ALL SELECT 6, 'payments', order_id, 'o', count(*) FROM s1 GROUP BY order_id),
    partners AS (
      SELECT 1 AS step, order_id AS key, count(*) AS m FROM items_c GROUP BY order_id
      UNION ALL SELECT 2, product_id, count(*) FROM products_c GROUP BY product_id
      UNION ALL SELECT 3, customer_id, count(*) FROM customers_c GROUP BY customer_id
      UNION ALL SELECT 4, seller_id, count(*) FROM sellers_c GROUP BY seller_id
      UNION ALL SELECT 5, order_id, count(*) FROM reviews_c GROUP BY order_id
      UNION ALL SELECT 6, order_id, count(*) FROM payments_agg GROUP BY order_id)
    SELECT steps.step, "table", CAST(sum(n) AS BIGINT) AS rows_before, CAST(sum(n * coalesce(m, 1)) AS BIGINT) AS rows_after,
      CAST(sum(CASE WHEN m IS NULL THEN n ELSE 0 END) AS BIGINT) AS rows_unmatched, count_if(m > 1) AS keys_repeated
    FROM steps LEFT JOIN partners ON steps.step = partners.step AND steps.key = partners.key GROUP BY ALL""",
)
def audit(spark, sf):
    return merge_audit(bindings.canonical_tables(spark, sf))


@query(
    "c10_orphans",
    W
    + """SELECT 'payments' AS child, 'orders' AS parent, 'order_id' AS key, count(*) AS orphans
      FROM payments_c WHERE order_id NOT IN (SELECT order_id FROM orders_c)
    UNION ALL SELECT 'order_items', 'payments', 'order_id', count(*) FROM items_c
      WHERE order_id NOT IN (SELECT order_id FROM payments_c)""",
)
def orphans(spark, sf):
    relations = [("payments", "orders", "order_id"), ("order_items", "payments", "order_id")]
    return orphan_counts(bindings.canonical_tables(spark, sf), relations)

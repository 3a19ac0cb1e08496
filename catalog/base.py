"""Registry of queries and their SQL oracles, and the SQL form of the canonical tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopsight.operators.joins import merge_tables
from shopsight.operators.targets import add_targets
from shopsight.sources import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NUDGE = 1e-7


def _nudged(sql: str) -> str:
    """Give every rounding to four digits the same nudge as `rounded`."""
    nudge = f" + {NUDGE:.7f}::DOUBLE, 4)"
    return sql.replace(nudge, ", 4)").replace(", 4)", nudge)


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is its oracle on the same tables."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _nudged(sql)
        return fn

    return keep


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show; nudged off exact ties first."""
    return df.select(
        *[
            F.round(F.col(f.name) + NUDGE, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(*names: str, digits: int = 4) -> str:
    """The same rounding as a SQL select list."""
    return ", ".join(f"round({n} + {NUDGE:.7f}::DOUBLE, {digits}) AS {n}" for n in names)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return add_targets(merge_tables(bindings.canonical_tables(spark, sf)))


def wide_kept(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Some columns of the wide frame, kept with the result: a query that reads them several times joins the tables once."""
    return wide(spark, sf).select(*columns).persist()


_STATES = ", ".join(f"'{s}'" for s in [*bindings.STATES[:23], "zz"])

# The canonical tables in SQL, written independently of the Spark bindings.
W = f"""WITH
orders_c AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    bought AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 31 <> 0 THEN
      bought + to_seconds(((o_orderkey * 7) % 40 + 5) * 86400 + (o_orderkey % 24) * 3600) END AS order_delivered_customer_date,
    bought + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM (SELECT *, o_orderdate + to_minutes((o_orderkey * 37) % 1440) AS bought FROM orders)
),
items_c AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
    l_extendedprice AS price, l_extendedprice * l_tax AS freight_value FROM lineitem
),
products_c AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 23 <> 0 THEN p_brand END AS product_category_name,
    CASE WHEN p_partkey % 23 <> 0 THEN replace(p_brand, 'Brand#', 'category_') END AS product_category_name_english,
    length(p_name) AS product_name_lenght, CAST(trunc(p_retailprice) AS INT) AS product_description_lenght,
    CASE WHEN p_partkey % 29 <> 0 THEN p_partkey % 6 + 1 END AS product_photos_qty,
    CASE WHEN p_partkey % 17 <> 0 THEN p_size * 100.0::DOUBLE END AS product_weight_g,
    p_size + 10.0::DOUBLE AS product_length_cm, p_partkey % 30 + 2.0::DOUBLE AS product_height_cm,
    p_partkey % 20 + 5.0::DOUBLE AS product_width_cm
  FROM part
),
customers_c AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
    n_name AS customer_city, [{_STATES}][c_nationkey + 1] AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
sellers_c AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_city,
    [{_STATES}][s_nationkey + 1] AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
payments_c AS (
  SELECT event_id - event_id % 2 AS order_id, event_id % 2 + 1 AS payment_sequential, event_type AS payment_type,
    CAST(json_extract_string(props, '$.k') AS INT) % 12 + 1 AS payment_installments, value AS payment_value FROM events
),
payment_types AS (
  SELECT order_id, payment_type FROM (
    SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, payment_type) AS k
    FROM payments_c GROUP BY order_id, payment_type) WHERE k = 1
),
payments_agg AS (
  SELECT order_id, sum(payment_value) AS payment_value, max(payment_installments) AS payment_installments,
    any_value(t.payment_type) AS payment_type, count(payment_sequential) AS payment_methods_count
  FROM payments_c JOIN payment_types t USING (order_id) GROUP BY order_id
),
reviews_c AS (
  SELECT o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS review_score, text AS review_comment_message
  FROM orders LEFT JOIN documents ON doc_id = o_orderkey WHERE o_orderkey % 41 <> 0
),
geo_c AS (
  SELECT c_nationkey AS zip, avg(c_nationkey * 3.0::DOUBLE - 36 + (c_custkey % 10) * 0.01::DOUBLE) AS lat,
    avg(c_nationkey * 7.0::DOUBLE - 84 + (c_custkey % 7) * 0.01::DOUBLE) AS lng
  FROM customer WHERE c_nationkey <> 22 GROUP BY c_nationkey
),
wide AS (
  SELECT * FROM orders_c LEFT JOIN items_c USING (order_id) LEFT JOIN products_c USING (product_id)
    LEFT JOIN customers_c USING (customer_id) LEFT JOIN sellers_c USING (seller_id)
    LEFT JOIN reviews_c USING (order_id) LEFT JOIN payments_agg USING (order_id)
),
tw AS (
  SELECT *, CAST(coalesce(review_score >= 4, false) AS INT) AS is_satisfied,
    (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0::DOUBLE AS delivery_days,
    CAST(coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS INT) AS is_late_delivery,
    (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 86400000000.0::DOUBLE
      AS delivery_delay_days
  FROM wide
),
ref AS (SELECT max(order_purchase_timestamp) AS last_at FROM orders_c),
cust0 AS (
  SELECT customer_unique_id,
    CAST(floor((epoch_us((SELECT last_at FROM ref)) - epoch_us(max(order_purchase_timestamp))) / 86400000000.0::DOUBLE) AS BIGINT) AS recency,
    count(DISTINCT order_id) AS frequency, coalesce(sum(payment_value), 0.0::DOUBLE) AS monetary,
    avg(review_score) AS avg_review_score, avg(delivery_days) AS avg_delivery_days,
    avg(is_late_delivery) AS late_delivery_rate, avg(price) AS avg_price, count(order_item_id) AS total_items
  FROM tw WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id
),
fav AS (
  SELECT customer_unique_id, product_category_name_english AS favorite_category FROM (
    SELECT customer_unique_id, product_category_name_english, row_number() OVER (
      PARTITION BY customer_unique_id ORDER BY count(*) DESC, product_category_name_english) AS k
    FROM tw WHERE product_category_name_english IS NOT NULL
    GROUP BY customer_unique_id, product_category_name_english) WHERE k = 1
),
cust AS (
  SELECT * EXCLUDE (avg_review_score, avg_delivery_days, favorite_category),
    coalesce(avg_review_score, (SELECT quantile_cont(avg_review_score, 0.5) FROM cust0)) AS avg_review_score,
    coalesce(avg_delivery_days, (SELECT quantile_cont(avg_delivery_days, 0.5) FROM cust0)) AS avg_delivery_days,
    coalesce(favorite_category, 'unknown') AS favorite_category,
    monetary / frequency AS avg_order_value, monetary / (recency + 1) AS monetary_per_day
  FROM cust0 LEFT JOIN fav USING (customer_unique_id)
)
"""

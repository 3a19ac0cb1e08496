"""Splits, targets and filters."""

from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide
from catalog.sources import _CUTS, _split_orders
from shopsight.operators.split import (
    apply_split,
    assign_customer_split,
    assign_stratified_split,
    expanding_folds,
    rows_of_split,
    split_overlaps,
    stratified_folds,
    undersample,
)
from shopsight.operators.targets import correct_types, logical_filter, select_features, with_target
from shopsight.sources import bindings


def _labelled(spark, sf):
    return bindings.table(spark, sf, "labels")


@query("b1_time_split", W + _CUTS + "SELECT order_id, split FROM split")
def time_split(spark, sf):
    return _split_orders(spark, sf).select("order_id", "split")


@query(
    "b2_apply_split",
    W + _CUTS + """SELECT split, count(*) AS n, round(sum(price), 4) AS revenue
    FROM items_c JOIN split USING (order_id) GROUP BY split""",
)
def applied(spark, sf):
    items = apply_split(bindings.order_items(spark, sf), _split_orders(spark, sf))
    return rounded(items.groupBy("split").agg(F.count("*").alias("n"), F.sum("price").alias("revenue")))


@query(
    "b3_targets",
    W + "SELECT order_id, order_item_id, price, is_satisfied, is_late_delivery, "
    + r("delivery_days", "delivery_delay_days") + " FROM tw",
)
def targets(spark, sf):
    names = ["order_id", "order_item_id", "price", "is_satisfied", "is_late_delivery", "delivery_days", "delivery_delay_days"]
    return rounded(wide(spark, sf).select(*names))


@query(
    "b4_correct_types",
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 11 = 0 THEN 'many'
      ELSE CAST(CAST(json_extract_string(props, '$.k') AS INT) AS VARCHAR) END AS INT) AS payment_installments FROM events""",
)
def types(spark, sf):
    raw = bindings.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, "many").otherwise(F.get_json_object("props", "$.k")).alias("payment_installments"),
    )
    return correct_types(raw)


@query(
    "b5_select_features",
    W + "SELECT " + r("price", "freight_value", "delivery_days") + " FROM tw",
)
def features(spark, sf):
    return rounded(select_features(wide(spark, sf), ["price", "freight_value", "absent", "delivery_days"]))


@query(
    "b6_stratified_split",
    """SELECT quality, split, n FROM (
      SELECT quality, CAST(floor(count(*) * 0.7::DOUBLE) AS BIGINT) AS a,
        CAST(floor(count(*) * 0.85::DOUBLE) AS BIGINT) AS b, count(*) AS c FROM labels GROUP BY quality) s,
      LATERAL (SELECT unnest(['train', 'val', 'test']) AS split, unnest([a, b - a, c - b]) AS n) WHERE n > 0""",
)
def stratified(spark, sf):
    return assign_stratified_split(_labelled(spark, sf), "doc_id", "quality").groupBy("quality", "split").agg(F.count("*").alias("n"))


@query(
    "b7_customer_split",
    "SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_custkey) AS memberships, count(*) AS orders FROM orders",
)
def customer_split(spark, sf):
    """A customer belongs to one split: as many (customer, split) pairs as customers."""
    split = assign_customer_split(bindings.orders(spark, sf), "customer_id")
    return split.agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("customer_id", "split").alias("memberships"),
        F.count("*").alias("orders"),
    )


@query(
    "b8_logical_filter",
    """SELECT count(*) AS "rows", count_if(l_shipdate < o_orderdate) AS delivered_before_purchase,
      count_if(l_extendedprice - 50000 <= 0) AS price_not_positive FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def constraints(spark, sf):
    lines = bindings.table(spark, sf, "lineitem").join(
        bindings.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    named = lines.select(
        F.col("l_shipdate").alias("order_delivered_customer_date"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.col("l_extendedprice") - 50000).alias("price"),
    )
    return logical_filter(named)[1]


@query("b9_known_target", W + "SELECT order_id, round(delivery_days, 4) AS delivery_days FROM tw WHERE delivery_days IS NOT NULL")
def known_target(spark, sf):
    return rounded(with_target(wide(spark, sf)).select("order_id", "delivery_days"))


@query("c8_semi_join", W + _CUTS + "SELECT order_id, order_item_id, price FROM items_c WHERE order_id IN (SELECT order_id FROM split WHERE split = 'test')")
def semi(spark, sf):
    return rows_of_split(bindings.order_items(spark, sf), _split_orders(spark, sf), "test").select("order_id", "order_item_id", "price")


@query("c9_split_overlap", "SELECT unnest(['train-val', 'train-test', 'val-test']) AS pair, 0::BIGINT AS shared_ids")
def overlap(spark, sf):
    return split_overlaps(_split_orders(spark, sf))


@query(
    "l7_stratified_folds",
    """SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 5 AS INT) AS fold
    FROM labels""",
)
def folds(spark, sf):
    return stratified_folds(_labelled(spark, sf), "doc_id", "quality", seed=None).select("doc_id", "quality", "fold")


@query(
    "l19_time_series_folds",
    """SELECT block, count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS first FROM (
      SELECT o_orderdate, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= c - s * 5 THEN 0
        ELSE (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 - (c - s * 5)) // s + 1 END::INT AS block
      FROM orders, (SELECT count(*) AS c, count(*) // 6 AS s FROM orders)) GROUP BY block""",
)
def time_folds(spark, sf):
    orders = bindings.table(spark, sf, "orders")
    return expanding_folds(orders, "o_orderdate", "o_orderkey").groupBy("block").agg(
        F.count("*").alias("n"), F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first")
    )


@query(
    "l20_undersample",
    "SELECT toxic, (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic)) AS n FROM labels GROUP BY toxic",
)
def undersampled(spark, sf):
    return undersample(_labelled(spark, sf), "doc_id", "toxic").groupBy("toxic").agg(F.count("*").alias("n"))

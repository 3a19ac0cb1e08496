"""Aggregations, profiles, sorts and limits."""

from pyspark.sql import functions as F

from catalog.base import NUDGE, W, query, r, rounded, wide, wide_kept
from shopsight.functions.text import text_columns
from shopsight.operators import aggregates as A, profile as P
from shopsight.operators.joins import payments_per_order
from shopsight.sources import bindings


@query(
    "d1_payments_per_order",
    W + "SELECT order_id, round(payment_value, 4) AS payment_value, payment_installments, payment_type, payment_methods_count FROM payments_agg",
)
def payments(spark, sf):
    return rounded(payments_per_order(bindings.payments(spark, sf)))


@query(
    "d1_payments_per_user",
    """WITH t AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS k
      FROM events GROUP BY user_id, event_type)
    SELECT e.user_id, round(sum(value), 4) AS payment_value,
      max(CAST(json_extract_string(props, '$.k') AS INT) % 12 + 1) AS payment_installments,
      any_value(t.event_type) AS payment_type, count(*) AS payment_methods_count
    FROM events e JOIN t ON e.user_id = t.user_id AND t.k = 1 GROUP BY e.user_id""",
)
def payments_by_user(spark, sf):
    pay = bindings.table(spark, sf, "events").select(
        "user_id",
        F.col("event_id").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (F.get_json_object("props", "$.k").cast("int") % 12 + 1).alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )
    return rounded(payments_per_order(pay, "user_id"))


@query(
    "d2_rfm",
    W + "SELECT customer_unique_id, recency, frequency, " + r("monetary", "avg_order_value", "monetary_per_day") + " FROM cust",
)
def rfm(spark, sf):
    return rounded(A.rfm(wide(spark, sf)))


@query(
    "d2_rfm_once_per_order",
    W
    + "SELECT customer_unique_id, recency, frequency, " + r("monetary", "avg_order_value", "monetary_per_day")
    + """ FROM (SELECT customer_unique_id, recency, c.frequency, p.monetary AS monetary,
      p.monetary / c.frequency AS avg_order_value, p.monetary / (recency + 1) AS monetary_per_day
    FROM cust c JOIN (SELECT customer_id AS customer_unique_id, coalesce(sum(payment_value), 0.0::DOUBLE) AS monetary
      FROM orders_c LEFT JOIN payments_agg USING (order_id) GROUP BY 1) p USING (customer_unique_id))""",
)
def rfm_once(spark, sf):
    return rounded(A.rfm(wide(spark, sf), dedup_by="order_id"))


_BEHAVIOUR = ["monetary", "avg_review_score", "avg_delivery_days", "late_delivery_rate", "avg_price", "avg_order_value", "monetary_per_day"]


@query(
    "d3_customer_behaviour",
    W + "SELECT customer_unique_id, recency, frequency, total_items, favorite_category, " + r(*_BEHAVIOUR) + " FROM cust",
)
def behaviour(spark, sf):
    return rounded(A.customer_behaviour(wide(spark, sf)))


@query(
    "d4_category_prices",
    W
    + """SELECT product_category_name_english, round(avg(price), 4) AS category_price_mean,
    round(coalesce(stddev_samp(price), 1.0), 4) AS category_price_std
    FROM tw WHERE product_category_name_english IS NOT NULL GROUP BY 1""",
)
def category_prices(spark, sf):
    return rounded(A.category_price_stats(wide(spark, sf)))


_PROFILED = ["order_id", "product_category_name", "product_weight_g", "review_score", "payment_type", "order_delivered_customer_date"]


def _profiled(spark, sf):
    return wide(spark, sf).select(*_PROFILED)


@query(
    "d5_basic_stats",
    W
    + ", x AS (SELECT " + ", ".join(_PROFILED) + " FROM tw), m AS (SELECT CAST(sum("
    + " + ".join(f"({c} IS NULL)::INT" for c in _PROFILED)
    + """) AS BIGINT) AS total_missing, count(*) AS n FROM x)
    SELECT n AS "rows", 6 AS "columns", n - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) AS duplicates, total_missing,
      round(total_missing * 100.0::DOUBLE / (n * 6), 2) AS missing_pct FROM m""",
)
def basic(spark, sf):
    return P.basic_stats(_profiled(spark, sf))


_TYPES = {
    "order_id": "bigint",
    "product_category_name": "string",
    "product_weight_g": "double",
    "review_score": "int",
    "payment_type": "string",
    "order_delivered_customer_date": "timestamp",
}


@query(
    "d6_column_profile",
    W
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS null_count,
        round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_pct, count(DISTINCT {c}) AS "unique",
        CAST(min({c}) AS VARCHAR) AS sample FROM tw"""
        for c, t in _TYPES.items()
    ),
)
def columns(spark, sf):
    return P.column_profile(_profiled(spark, sf))


_ADVICE = {"bigint": "median", "double": "median", "int": "median", "string": "mode_or_unknown", "timestamp": "keep_null"}


@query(
    "d7_missing_values",
    W
    + """SELECT * EXCLUDE (advice), CASE WHEN missing_pct = 0 THEN 'none' WHEN missing_pct > 50 THEN 'drop_column'
        ELSE advice END AS suggested_strategy FROM ("""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct, '{t}' AS dtype, '{_ADVICE[t]}' AS advice FROM tw"""
        for c, t in _TYPES.items()
    )
    + ")",
)
def missing(spark, sf):
    return P.missing_values(_profiled(spark, sf))


@query(
    "d8_class_balance",
    W
    + """, c AS (SELECT is_satisfied AS v, count(*) AS n FROM tw GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS total_samples, arg_max(v, n) AS majority_class, arg_min(v, n) AS minority_class,
      round(max(n) / min(n), 2) AS imbalance_ratio, max(n) / min(n) > 3 AS is_imbalanced FROM c""",
)
def balance(spark, sf):
    return P.class_balance(wide(spark, sf))


@query(
    "d8_class_shares",
    W + "SELECT is_satisfied, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM tw), 2) AS pct FROM tw GROUP BY 1",
)
def shares(spark, sf):
    return P.value_shares(wide(spark, sf), "is_satisfied")


@query(
    "d9_regression_target",
    W
    + """, q AS (SELECT quantile_cont(delivery_days, 0.25) AS q1, quantile_cont(delivery_days, 0.75) AS q3 FROM tw)
    SELECT count(delivery_days) AS total_samples, count(*) - count(delivery_days) AS null_count,
      round(avg(delivery_days), 2) AS mean, round(quantile_cont(delivery_days, 0.5), 2) AS median,
      round(stddev_samp(delivery_days), 2) AS std, round(min(delivery_days), 2) AS min, round(max(delivery_days), 2) AS max,
      round(skewness(delivery_days), 2) AS skewness, round(kurtosis(delivery_days), 2) AS kurtosis,
      count_if(delivery_days < q1 - 1.5 * (q3 - q1) OR delivery_days > q3 + 1.5 * (q3 - q1)) AS outliers_count,
      round(count_if(delivery_days < q1 - 1.5 * (q3 - q1) OR delivery_days > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE
        / count(delivery_days), 2) AS outliers_pct,
      any_value(round(q1 - 1.5::DOUBLE * (q3 - q1), 2)) AS iqr_lower, any_value(round(q3 + 1.5::DOUBLE * (q3 - q1), 2)) AS iqr_upper,
      abs(skewness(delivery_days)) > 1 AS needs_transform FROM tw, q""",
)
def regression(spark, sf):
    return P.regression_target(wide(spark, sf))


@query(
    "d10_temporal_range",
    W
    + """SELECT strftime(min(order_purchase_timestamp), '%Y-%m-%d') AS start, strftime(max(order_purchase_timestamp), '%Y-%m-%d') AS "end",
      (epoch_us(max(order_purchase_timestamp)) - epoch_us(min(order_purchase_timestamp))) // 86400000000 AS span_days FROM orders_c""",
)
def temporal_range(spark, sf):
    return P.temporal_range(bindings.orders(spark, sf))


@query(
    "d10_temporal_counts",
    W
    + """SELECT 'dayofweek' AS part, CAST(isodow(order_purchase_timestamp) - 1 AS INT) AS value, count(*) AS orders FROM orders_c GROUP BY 2
    UNION ALL SELECT 'month', CAST(month(order_purchase_timestamp) AS INT), count(*) FROM orders_c GROUP BY 2
    UNION ALL SELECT 'hour', CAST(hour(order_purchase_timestamp) AS INT), count(*) FROM orders_c GROUP BY 2""",
)
def temporal_counts(spark, sf):
    return P.temporal_counts(bindings.orders(spark, sf))


_TOP = """SELECT product_category_name AS value, count(*) AS n,
      round(count(*) * 100.0::DOUBLE / (SELECT count(product_category_name) FROM tw), 2) AS pct,
      (SELECT count(DISTINCT product_category_name) FROM tw) AS unique_values,
      (SELECT count(*) - count(product_category_name) FROM tw) AS null_count
    FROM tw WHERE product_category_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10"""


@query("d11_categorical_profile", W + _TOP)
def categorical(spark, sf):
    return P.categorical_profile(wide(spark, sf), "product_category_name", 10)


@query("w3_top_values", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def top_values(spark, sf):
    return P.categorical_profile(bindings.table(spark, sf, "events"), "event_type", 3).select("value", "n")


_CORR = ["price", "freight_value", "review_score", "delivery_days", "delivery_delay_days", "payment_value", "is_late_delivery"]
_PAIRS = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i + 1 :]]


@query(
    "d12_correlation_pairs",
    W + " UNION ALL ".join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 4) AS correlation FROM tw" for a, b in _PAIRS),
)
def correlations(spark, sf):
    return rounded(P.correlation_pairs(wide(spark, sf), _CORR))


@query(
    "d12_high_correlations",
    W
    + "SELECT feature_1, feature_2, round(c, 3) AS correlation FROM ("
    + " UNION ALL ".join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS c FROM tw" for a, b in _PAIRS)
    + ") WHERE abs(c) >= 0.7",
)
def high_correlations(spark, sf):
    return P.high_correlations(wide(spark, sf), _CORR)


_TARGETED = [c for c in _CORR if c != "review_score"]
_TARGET_SQL = W + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, review_score), 4) AS correlation FROM tw" for c in _TARGETED)


@query("d12_target_correlations", _TARGET_SQL)
@query("d17_correlation_with_target", _TARGET_SQL)
@query("w2_sorted_by_magnitude", _TARGET_SQL)
def target_correlations(spark, sf):
    return rounded(P.target_correlations(wide(spark, sf), "review_score", _CORR))


_PROFILE = ["recency", "monetary", "avg_review_score"]
_CLUSTERED = ", k AS (SELECT *, CAST(frequency % 4 AS INT) AS cluster_id FROM cust)"


def _clustered(spark, sf):
    return A.customer_behaviour(wide(spark, sf)).withColumn("cluster_id", (F.col("frequency") % 4).cast("int"))


@query(
    "d13_cluster_profile",
    W
    + _CLUSTERED
    + " UNION ALL ".join(
        f"""SELECT cluster_id, '{c}' AS feature, round(avg({c}), 2) AS mean, round(quantile_cont({c}, 0.5), 2) AS median,
        round(stddev_samp({c}), 2) AS std FROM k GROUP BY cluster_id"""
        for c in _PROFILE
    ),
)
def cluster_profile(spark, sf):
    return A.cluster_profile(_clustered(spark, sf), "cluster_id", _PROFILE)


@query(
    "d13_cluster_summary",
    W
    + _CLUSTERED
    + "SELECT cluster_id, "
    + ", ".join(f"round(avg({c}), 2) AS {c}" for c in _PROFILE)
    + ", count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM k), 1) AS pct FROM k GROUP BY cluster_id",
)
def cluster_summary(spark, sf):
    return A.cluster_summary(_clustered(spark, sf), "cluster_id", _PROFILE)


@query("d14_monthly_counts", W + "SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS orders FROM orders_c GROUP BY 1")
def monthly(spark, sf):
    return A.monthly_counts(bindings.orders(spark, sf))


@query(
    "d15_mean_by_group",
    W + """SELECT review_score, round(avg(len(list_filter(regexp_split_to_array(coalesce(review_comment_message, ''), '\\s+'), lambda x: x <> ''))), 4)
      AS review_word_count FROM reviews_c GROUP BY 1""",
)
def mean_by_group(spark, sf):
    reviews = bindings.reviews(spark, sf)
    counted = reviews.withColumns(text_columns("review_comment_message"))
    return rounded(A.mean_by(counted, "review_score", ["review_word_count"]))


_DESCRIBED = ["price", "delivery_days", "payment_value"]


@query(
    "d16_describe",
    W
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(skewness({c}), 4) AS skewness,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM tw"""
        for c in _DESCRIBED
    ),
)
def describe(spark, sf):
    return rounded(P.describe_numeric(wide(spark, sf), _DESCRIBED))


@query(
    "d18_revenue_by_state",
    W + "SELECT customer_state, round(coalesce(sum(payment_value), 0.0), 4) AS revenue FROM tw WHERE customer_state IS NOT NULL GROUP BY 1",
)
def revenue(spark, sf):
    return rounded(A.revenue_by(wide(spark, sf)))


@query(
    "d19_seller_history",
    W
    + """, m AS (SELECT seller_id, order_purchase_timestamp AS t, sum(review_score) AS s, count(review_score) AS c
      FROM tw WHERE seller_id IS NOT NULL GROUP BY ALL),
    h AS (SELECT seller_id, t, sum(s) OVER w AS s, sum(c) OVER w AS c FROM m
      WINDOW w AS (PARTITION BY seller_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT order_id, order_item_id, price, round(CASE WHEN c > 0 THEN s / c END, 4) AS seller_historical_rating
    FROM tw LEFT JOIN h ON tw.seller_id = h.seller_id AND order_purchase_timestamp = h.t""",
)
def seller_history(spark, sf):
    kept = wide_kept(spark, sf, "order_id", "order_item_id", "price", "seller_id", "order_purchase_timestamp", "review_score")
    out = A.seller_history(kept)
    return rounded(out.select("order_id", "order_item_id", "price", "seller_historical_rating"))


@query(
    "d20_customer_tenure",
    W
    + """SELECT order_id, (epoch_us(order_purchase_timestamp) - epoch_us(min(order_purchase_timestamp) OVER (PARTITION BY customer_id)))
      // 86400000000 AS days_since_first_order,
      round((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0::DOUBLE, 4) AS days_promised
    FROM orders_c""",
)
def tenure(spark, sf):
    return rounded(A.customer_tenure(bindings.orders(spark, sf), "customer_id").select("order_id", "days_since_first_order", "days_promised"))


@query(
    "d21_histogram",
    W
    + """, b AS (SELECT min(price) AS lo, (max(price) - min(price)) / 50 AS w FROM items_c)
    SELECT CAST(least(49, floor((price - lo) / w)) AS INT) AS bin, round(any_value(lo) + least(49, floor((price - lo) / w)) * any_value(w), 4) AS left_edge,
      count(*) AS n, round(count(*) / ((SELECT count(*) FROM items_c) * any_value(w)), 8) AS density
    FROM items_c, b GROUP BY least(49, floor((price - lo) / w))""",
)
def histogram(spark, sf):
    out = P.histogram(bindings.order_items(spark, sf), "price", 50)
    return out.withColumns({"left_edge": F.round(F.col("left_edge") + NUDGE, 4), "density": F.round("density", 8)})


@query(
    "d21_cluster_histogram",
    W
    + _CLUSTERED
    + """, b AS (SELECT min(recency) AS lo, (max(recency) - min(recency)) / 30 AS w FROM k),
    c AS (SELECT cluster_id, CAST(least(29, floor((recency - lo) / w)) AS INT) AS bin, count(*) AS n FROM k, b GROUP BY ALL)
    SELECT cluster_id, bin, round(lo + bin * w, 4) AS left_edge, n,
      round(n / (sum(n) OVER (PARTITION BY cluster_id) * w), 8) AS density FROM c, b""",
)
def cluster_histogram(spark, sf):
    out = P.histogram(_clustered(spark, sf), "recency", 30, by=["cluster_id"])
    return out.withColumns({"left_edge": F.round(F.col("left_edge") + NUDGE, 4), "density": F.round("density", 8)})


@query("w1_sorted_by_time", W + "SELECT order_id, CAST(row_number() OVER (ORDER BY order_purchase_timestamp, order_id) AS BIGINT) AS place FROM orders_c")
def sorted_by_time(spark, sf):
    from shopsight.operators.ranking import global_rank

    orders = bindings.orders(spark, sf)
    return global_rank(orders, ["order_purchase_timestamp", "order_id"], "place", rows_per_range=20_000).select("order_id", "place")


@query("w6_intersection", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey FROM part")
def intersection(spark, sf):
    left = bindings.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"))
    return left.intersect(bindings.table(spark, sf, "part").select(F.col("p_partkey").alias("k")))

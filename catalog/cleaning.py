"""Missing values, outliers, validation."""

from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide
from shopsight.operators import quality as Q
from shopsight.operators.profile import iqr_outliers
from shopsight.sources import bindings

_STRATEGIES = {
    "product_weight_g": ("median", None),
    "product_photos_qty": ("mean", None),
    "product_category_name": ("mode", None),
    "product_category_name_english": ("constant", "unknown"),
    "product_description_lenght": ("keep", None),
    "absent": ("median", None),
}
_IMPUTED = """, t AS (SELECT quantile_cont(product_weight_g, 0.5) AS w, avg(product_photos_qty) AS p FROM products_c),
m AS (SELECT product_category_name AS c FROM products_c WHERE product_category_name IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
"""


@query(
    "q1_impute",
    W
    + _IMPUTED
    + """SELECT product_id, round(coalesce(product_weight_g, w), 4) AS product_weight_g,
      round(coalesce(product_photos_qty, p), 4) AS product_photos_qty,
      coalesce(product_category_name, (SELECT c FROM m)) AS product_category_name,
      coalesce(product_category_name_english, 'unknown') AS product_category_name_english FROM products_c, t""",
)
def impute(spark, sf):
    products = bindings.products(spark, sf).join(bindings.category_translation(spark, sf), "product_category_name", "left")
    out = Q.Imputer(_STRATEGIES).fit_transform(products)
    names = ["product_id", "product_weight_g", "product_photos_qty", "product_category_name", "product_category_name_english"]
    return rounded(out.select(*names))


@query("q1_drop_strategy", W + "SELECT product_id FROM products_c WHERE product_weight_g IS NOT NULL")
def drop_strategy(spark, sf):
    out = Q.Imputer({"product_weight_g": ("drop", None)}).fit_transform(bindings.products(spark, sf))
    return out.select("product_id")


@query(
    "q2_winsorize",
    W
    + """, b AS (SELECT quantile_cont(price, 0.01) AS lo, quantile_cont(price, 0.99) AS hi,
      quantile_cont(payment_value, 0.01) AS plo, quantile_cont(payment_value, 0.99) AS phi FROM tw),
    x AS (SELECT order_id, order_item_id, seller_id, CASE WHEN price IS NOT NULL THEN greatest(lo, least(hi, price)) END AS price,
      CASE WHEN payment_value IS NOT NULL THEN greatest(plo, least(phi, payment_value)) END AS payment_value FROM tw, b)
    SELECT order_id, order_item_id, seller_id, """
    + r("price", "payment_value")
    + " FROM x",
)
def winsorize(spark, sf):
    out = Q.Winsorizer(columns=["price", "payment_value"]).fit_transform(wide(spark, sf))
    return rounded(out.select("order_id", "order_item_id", "seller_id", "price", "payment_value"))


_BOXED = ["price", "freight_value", "payment_value", "delivery_days"]


@query(
    "q3_iqr_outliers",
    W
    + """SELECT "column", round(q1, 2) AS Q1, round(q3, 2) AS Q3, round(q3 - q1, 2) AS IQR, round(q1 - 1.5 * (q3 - q1), 2) AS lower_bound,
      round(q3 + 1.5 * (q3 - q1), 2) AS upper_bound, low AS outliers_low, high AS outliers_high, low + high AS outliers_total,
      round((low + high) * 100.0::DOUBLE / n, 2) AS outliers_pct FROM ("""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", any_value(q1) AS q1, any_value(q3) AS q3, count({c}) AS n,
        count_if({c} < q1 - 1.5 * (q3 - q1)) AS low, count_if({c} > q3 + 1.5 * (q3 - q1)) AS high
        FROM tw, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM tw)"""
        for c in _BOXED
    )
    + ")",
)
def outliers(spark, sf):
    return iqr_outliers(wide(spark, sf), _BOXED)


_RULES = [
    Q.Rule("order_id", "integer", nullable=False),
    Q.Rule("order_status", "string", nullable=False, allowed=Q.ORDER_STATUSES),
    Q.Rule("product_id", "integer", nullable=False),
    Q.Rule("price", "number", low=0, high=100_000),
    Q.Rule("review_score", "number", low=2, high=4),
    Q.Rule("payment_type", "string", allowed=("click", "view", "purchase")),
    Q.Rule("is_satisfied", "integer", allowed=(0, 1)),
    Q.Rule("missing_column", "string"),
]


@query(
    "q4_validate",
    W
    + """SELECT 'order_id' AS "column", 'not_null' AS "check", count_if(order_id IS NULL) AS failures, NULL AS sample FROM tw
    UNION ALL SELECT 'order_status', 'not_null', count_if(order_status IS NULL), NULL FROM tw
    UNION ALL SELECT 'order_status', 'allowed', 0, NULL
    UNION ALL SELECT 'product_id', 'not_null', count_if(product_id IS NULL), NULL FROM tw
    UNION ALL SELECT 'price', 'at_least', count_if(price < 0), NULL FROM tw
    UNION ALL SELECT 'price', 'at_most', count_if(price > 100000), min(CASE WHEN price > 100000 THEN CAST(price AS VARCHAR) END) FROM tw
    UNION ALL SELECT 'review_score', 'at_least', count_if(review_score < 2), min(CASE WHEN review_score < 2 THEN CAST(review_score AS VARCHAR) END) FROM tw
    UNION ALL SELECT 'review_score', 'at_most', count_if(review_score > 4), min(CASE WHEN review_score > 4 THEN CAST(review_score AS VARCHAR) END) FROM tw
    UNION ALL SELECT 'payment_type', 'allowed', count_if(payment_type NOT IN ('click', 'view', 'purchase')),
      min(CASE WHEN payment_type NOT IN ('click', 'view', 'purchase') THEN payment_type END) FROM tw
    UNION ALL SELECT 'is_satisfied', 'allowed', 0, NULL
    UNION ALL SELECT 'missing_column', 'present', 1, NULL""",
)
def validated(spark, sf):
    return Q.violations(wide(spark, sf), _RULES)


_CLEAN = ["product_weight_g", "product_height_cm"]
_CLEANED = """, train AS (SELECT * FROM tw WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'),
f AS (SELECT quantile_cont(product_weight_g, 0.5) AS w, quantile_cont(product_height_cm, 0.5) AS h FROM train),
b AS (SELECT quantile_cont(coalesce(product_weight_g, w), 0.01) AS wl, quantile_cont(coalesce(product_weight_g, w), 0.99) AS wh,
  quantile_cont(coalesce(product_height_cm, h), 0.01) AS hl, quantile_cont(coalesce(product_height_cm, h), 0.99) AS hh FROM train, f)
"""
_CLEAN_SELECT = """SELECT order_id, order_item_id, price,
  round(greatest(wl, least(wh, coalesce(product_weight_g, w))), 4) AS product_weight_g,
  round(greatest(hl, least(hh, coalesce(product_height_cm, h))), 4) AS product_height_cm FROM """


def _cleaned(spark, sf):
    df = wide(spark, sf)
    cut = F.lit("1999-01-01").cast("timestamp")
    train = df.where(F.col("order_purchase_timestamp") < cut)
    rest = df.where(F.col("order_purchase_timestamp") >= cut)
    strategies = {c: ("median", None) for c in _CLEAN}
    clean, model = Q.clean_training(train, check=False, strategies=strategies, outlier_columns=_CLEAN)
    return clean, rest, model


@query("q5_clean_training", W + _CLEANED + _CLEAN_SELECT + "train, f, b")
def clean_training(spark, sf):
    return rounded(_cleaned(spark, sf)[0].select("order_id", "order_item_id", "price", *_CLEAN))


@query("q6_clean_inference", W + _CLEANED + _CLEAN_SELECT + "tw, f, b WHERE order_purchase_timestamp >= TIMESTAMP '1999-01-01'")
def clean_inference(spark, sf):
    _, rest, model = _cleaned(spark, sf)
    return rounded(model.transform(rest).select("order_id", "order_item_id", "price", *_CLEAN))


@query(
    "q7_drop_repeats",
    """SELECT order_id, line, price FROM (SELECT l_orderkey AS order_id, l_linenumber AS line, round(l_extendedprice, 4) AS price,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice) AS k FROM lineitem) WHERE k = 1""",
)
def drop_repeats(spark, sf):
    lines = bindings.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("price")
    )
    return rounded(Q.drop_repeats(lines, ["order_id", "line"], ["price"]))


@query(
    "q7_repeats",
    "SELECT l_orderkey AS order_id, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeats(spark, sf):
    lines = bindings.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line")
    )
    return Q.repeats(lines, ["order_id", "line"])


@query(
    "q8_zscore_flags",
    """SELECT event_id, CAST(abs(value - (SELECT avg(value) FROM events)) > 2 * (SELECT stddev_samp(value) FROM events) AS INT) AS value_outlier
    FROM events""",
)
def zscore(spark, sf):
    return Q.zscore_outliers(bindings.table(spark, sf, "events"), ["value"], 2.0).select("event_id", "value_outlier")


@query(
    "q8_zscore_cap",
    """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
    SELECT event_id, round(greatest(m - 2 * d, least(m + 2 * d, value)), 4) AS value FROM events, s""",
)
def zscore_cap(spark, sf):
    return rounded(Q.zscore_outliers(bindings.table(spark, sf, "events"), ["value"], 2.0, "cap").select("event_id", "value"))


@query(
    "q9_forward_fill",
    """SELECT event_id, round(last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS value FROM events""",
)
def forward_fill(spark, sf):
    gaps = bindings.table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 3 == 0, F.col("value")))
    return rounded(Q.forward_fill(gaps, ["user_id"], ["ts", "event_id"], ["value"], rows_per_range=2_000).select("event_id", "value"))


@query(
    "q10_rejects",
    W
    + """SELECT order_id, seller_id, round(price, 4) AS price, array_to_string(list_filter([
        CASE WHEN product_id IS NULL THEN 'product_id:not_null' END,
        CASE WHEN price > 100000 THEN 'price:at_most' END,
        CASE WHEN payment_type NOT IN ('click', 'view', 'purchase') THEN 'payment_type:allowed' END], lambda x: x IS NOT NULL), ';') AS reasons
    FROM tw WHERE product_id IS NULL OR price > 100000 OR payment_type NOT IN ('click', 'view', 'purchase')""",
)
def rejects(spark, sf):
    rules = [_RULES[2], Q.Rule("price", "number", high=100_000), _RULES[5]]
    _, rejected = Q.split_valid(wide(spark, sf), rules)
    return rounded(rejected.select("order_id", "seller_id", "price", F.concat_ws(";", "reasons").alias("reasons")))

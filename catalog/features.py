"""Feature functions, the feature frame, encodings."""

from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide, wide_kept
from shopsight.functions.calendar import add_calendar_features, month_cycle, time_of_day
from shopsight.functions.commerce import payment_columns
from shopsight.functions.geo import great_circle_km, region_of
from shopsight.functions.text import add_text_features, capitals_share, lexicon_sentiment, sentiment_label
from shopsight.operators import encode as E
from shopsight.operators.joins import merge_tables, payments_per_order
from shopsight.plans.features import FITTED_COLUMNS, FeatureModel, add_geographic_features, add_product_features
from shopsight.sources import bindings
from shopsight.sources.readers import mean_coordinates

_TS = "order_purchase_timestamp"
_TWO_PI = "6.283185307179586::DOUBLE"


@query(
    "f1_calendar_parts",
    W
    + f"""SELECT order_id, CAST(hour({_TS}) AS INT) AS order_hour, CAST(isodow({_TS}) - 1 AS INT) AS order_dayofweek,
      CAST(month({_TS}) AS INT) AS order_month, CAST(day({_TS}) AS INT) AS order_day, CAST(quarter({_TS}) AS INT) AS order_quarter FROM orders_c""",
)
def calendar_parts(spark, sf):
    out = add_calendar_features(bindings.orders(spark, sf))
    return out.select("order_id", "order_hour", "order_dayofweek", "order_month", "order_day", "order_quarter")


@query(
    "f2_calendar_flags",
    W
    + f"""SELECT order_id, CAST(isodow({_TS}) >= 6 AS INT) AS is_weekend, CAST(day({_TS}) <= 7 AS INT) AS is_month_start,
      CAST(day({_TS}) >= 24 AS INT) AS is_month_end FROM orders_c""",
)
def calendar_flags(spark, sf):
    return add_calendar_features(bindings.orders(spark, sf)).select("order_id", "is_weekend", "is_month_start", "is_month_end")


_CYCLES = ["order_hour_sin", "order_hour_cos", "order_dayofweek_sin", "order_dayofweek_cos", "order_month_sin", "order_month_cos"]


@query(
    "f3_cyclic",
    W
    + f""", x AS (SELECT order_id, sin({_TWO_PI} * hour({_TS}) / 24) AS order_hour_sin, cos({_TWO_PI} * hour({_TS}) / 24) AS order_hour_cos,
      sin({_TWO_PI} * (isodow({_TS}) - 1) / 7) AS order_dayofweek_sin, cos({_TWO_PI} * (isodow({_TS}) - 1) / 7) AS order_dayofweek_cos,
      sin({_TWO_PI} * month({_TS}) / 12) AS order_month_sin, cos({_TWO_PI} * month({_TS}) / 12) AS order_month_cos FROM orders_c)
    SELECT order_id, """
    + r(*_CYCLES)
    + " FROM x",
)
def cyclic(spark, sf):
    out = add_calendar_features(bindings.orders(spark, sf)).withColumns(month_cycle(_TS))
    return rounded(out.select("order_id", *_CYCLES))


_KM = """CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 6371.0::DOUBLE * 2 * asin(sqrt(least(1.0, pow(sin(radians({b} - {a}) / 2), 2)
  + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2)))) END"""


@query(
    "f4_distance",
    W + ", x AS (SELECT a.zip AS zip_a, b.zip AS zip_b, " + _KM.format(a="a.lat", b="b.lat", c="a.lng", d="b.lng")
    + " AS km FROM geo_c a JOIN geo_c b ON b.zip = (a.zip * 7 + 3) % 25) SELECT zip_a, zip_b, round(km, 4) AS km FROM x",
)
def distance(spark, sf):
    geo = mean_coordinates(bindings.geolocation(spark, sf)).select(
        F.col("geolocation_zip_code_prefix").alias("zip"), F.col("geolocation_lat").alias("lat"), F.col("geolocation_lng").alias("lng")
    )
    a = geo.select(F.col("zip").alias("zip_a"), F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"))
    b = geo.select(F.col("zip").alias("zip_b"), F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"))
    pairs = a.join(b, F.col("zip_b") == (F.col("zip_a") * 7 + 3) % 25)
    return rounded(pairs.select("zip_a", "zip_b", great_circle_km("lat_a", "lng_a", "lat_b", "lng_b").alias("km")))


_REGION = """CASE WHEN upper({0}) IN ('SP', 'RJ', 'MG', 'ES') THEN 'SE' WHEN upper({0}) IN ('PR', 'SC', 'RS') THEN 'S'
  WHEN upper({0}) IN ('BA', 'PE', 'CE', 'MA', 'PB', 'RN', 'AL', 'SE', 'PI') THEN 'NE'
  WHEN upper({0}) IN ('AM', 'PA', 'AC', 'RO', 'RR', 'AP', 'TO') THEN 'N'
  WHEN upper({0}) IN ('GO', 'MT', 'MS', 'DF') THEN 'CO' ELSE 'unknown' END"""
_GEO = W + ", g AS (SELECT tw.*, " + _KM.format(a="c.lat", b="s.lat", c="c.lng", d="s.lng") + """ AS km
  FROM tw LEFT JOIN geo_c c ON customer_zip_code_prefix = c.zip LEFT JOIN geo_c s ON seller_zip_code_prefix = s.zip)"""


@query(
    "f5_geographic_features",
    _GEO
    + f"""SELECT order_id, order_item_id, price, round(coalesce(km, (SELECT quantile_cont(km, 0.5) FROM g)), 4) AS seller_customer_distance_km,
      CAST(customer_state IS NOT DISTINCT FROM seller_state AS INT) AS is_same_state,
      {_REGION.format('customer_state')} AS customer_region, {_REGION.format('seller_state')} AS seller_region FROM g""",
)
def geographic(spark, sf):
    geo = mean_coordinates(bindings.geolocation(spark, sf))
    out = add_geographic_features(merge_tables(bindings.canonical_tables(spark, sf)), geo)
    names = ["order_id", "order_item_id", "price", "seller_customer_distance_km", "is_same_state", "customer_region", "seller_region"]
    return rounded(out.select(*names))


@query("f6_region", W + f"SELECT customer_id, {_REGION.format('customer_state')} AS region FROM customers_c")
def region(spark, sf):
    return bindings.customers(spark, sf).select("customer_id", region_of("customer_state").alias("region"))


_PRODUCT = [
    "product_volume_cm3",
    "product_density",
    "price_per_kg",
    "freight_ratio",
    "category_price_mean",
    "category_price_std",
    "price_vs_category_mean",
    "price_vs_category_zscore",
]


@query(
    "f7_product_features",
    W
    + """, st AS (SELECT product_category_name_english AS c, avg(price) AS m, coalesce(stddev_samp(price), 1.0) AS s
      FROM tw WHERE product_category_name_english IS NOT NULL GROUP BY 1),
    j AS (SELECT tw.*, coalesce(m, (SELECT avg(price) FROM tw)) AS category_price_mean,
      coalesce(s, (SELECT stddev_samp(price) FROM tw)) AS category_price_std,
      product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
      FROM tw LEFT JOIN st ON product_category_name_english = c),
    x AS (SELECT *, product_weight_g / (product_volume_cm3 + 1) AS product_density, price / (product_weight_g / 1000 + 0.1) AS price_per_kg,
      freight_value / (price + 1) AS freight_ratio, price - category_price_mean AS price_vs_category_mean,
      (price - category_price_mean) / (category_price_std + 1) AS price_vs_category_zscore FROM j)
    SELECT order_id, order_item_id, seller_id, """
    + r(*_PRODUCT)
    + " FROM x",
)
def product(spark, sf):
    sizes = ("product_length_cm", "product_height_cm", "product_width_cm", "product_weight_g")
    kept = wide_kept(spark, sf, "order_id", "order_item_id", "seller_id", "product_category_name_english", "price", "freight_value", *sizes)
    out, _ = add_product_features(kept)
    return rounded(out.select("order_id", "order_item_id", "seller_id", *_PRODUCT))


_TEXT = """CAST(regexp_matches({0}, '\\S') AS INT) AS has_review_comment, CAST(length({0}) AS INT) AS review_text_length,
  CAST(len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> '')) AS INT) AS review_word_count,
  CAST(length({0}) - length(replace({0}, '!', '')) AS INT) AS review_exclamation_count,
  CAST(length({0}) - length(replace({0}, '?', '')) AS INT) AS review_question_count"""
_CAPS = """CASE WHEN length(regexp_replace({0}, '\\P{{L}}+', '', 'g')) > 0 THEN
  length(regexp_replace({0}, '\\P{{Lu}}+', '', 'g')) / length(regexp_replace({0}, '\\P{{L}}+', '', 'g')) ELSE 0.0 END"""


@query("f8_text_statistics", "SELECT doc_id, " + _TEXT.format("text") + " FROM documents")
def text_statistics(spark, sf):
    out = add_text_features(bindings.table(spark, sf, "documents"), "text")
    return out.select(
        "doc_id",
        "has_review_comment",
        "review_text_length",
        "review_word_count",
        "review_exclamation_count",
        "review_question_count",
    )


@query("f8_text_statistics_turns", "SELECT conv_id, turn, " + _TEXT.format("text") + " FROM conversations")
def text_statistics_turns(spark, sf):
    out = add_text_features(bindings.table(spark, sf, "conversations"), "text")
    return out.drop("text", "role", "review_caps_ratio")


@query(
    "f9_capitals_share",
    "SELECT doc_id, round(c, 4) AS share FROM (SELECT doc_id, " + _CAPS.format("text") + " AS c FROM documents)",
)
def capitals(spark, sf):
    return rounded(bindings.table(spark, sf, "documents").select("doc_id", capitals_share("text").alias("share")))


_LEXICON = """WITH lex AS (SELECT word, (length(word) % 5 - 2) / 2.0::DOUBLE AS polarity, (length(word) % 3) / 2.0::DOUBLE AS subjectivity
  FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS word FROM benchmark) WHERE word <> ''),
tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS word FROM documents),
sc AS (SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s FROM tok JOIN lex USING (word) GROUP BY doc_id),
x AS (SELECT doc_id, coalesce(p, 0.0) AS sentiment_polarity, coalesce(s, 0.0) AS sentiment_subjectivity
  FROM documents LEFT JOIN sc USING (doc_id))
"""


def _sentiment(spark, sf):
    documents = bindings.table(spark, sf, "documents").select("doc_id", "text")
    return lexicon_sentiment(documents, "doc_id", "text", bindings.lexicon(spark, sf)).drop("text")


@query("f10_sentiment", _LEXICON + "SELECT doc_id, " + r("sentiment_polarity", "sentiment_subjectivity") + " FROM x")
def sentiment(spark, sf):
    return rounded(_sentiment(spark, sf))


@query(
    "f14_sentiment_label",
    _LEXICON
    + """SELECT CASE WHEN round(sentiment_polarity, 6) <= -0.1 THEN 'negative' WHEN round(sentiment_polarity, 6) <= 0.1 THEN 'neutral'
      ELSE 'positive' END AS label, count(*) AS n FROM x GROUP BY 1""",
)
def sentiment_labels(spark, sf):
    labelled = _sentiment(spark, sf).select(sentiment_label(F.round("sentiment_polarity", 6)).alias("label"))
    return labelled.groupBy("label").agg(F.count("*").alias("n"))


@query(
    "f11_payment_features",
    W
    + """, x AS (SELECT order_id, payment_value / (coalesce(payment_installments, 1) + 1) AS payment_per_installment,
      CAST(coalesce(payment_installments, 1) <= 1 AS INT) AS is_full_payment,
      CAST(coalesce(payment_installments, 1) >= 6 AS INT) AS is_high_installment
      FROM orders_c LEFT JOIN payments_agg USING (order_id))
    SELECT order_id, is_full_payment, is_high_installment, """
    + r("payment_per_installment")
    + " FROM x",
)
def payment(spark, sf):
    paid = bindings.orders(spark, sf).join(payments_per_order(bindings.payments(spark, sf)), "order_id", "left")
    out = paid.withColumns(payment_columns())
    return rounded(out.select("order_id", "is_full_payment", "is_high_installment", "payment_per_installment"))


@query("f12_log1p", W + "SELECT customer_unique_id, round(ln(1 + frequency), 4) AS frequency_log, round(ln(1 + monetary), 4) AS monetary_log FROM cust0")
def logs(spark, sf):
    from shopsight.operators.aggregates import rfm

    out = E.log_transformed(rfm(wide(spark, sf)), ["frequency", "monetary"])
    return rounded(out.select("customer_unique_id", "frequency_log", "monetary_log"))


@query(
    "f13_time_of_day",
    W
    + f"""SELECT order_id, CASE WHEN hour({_TS}) <= 6 THEN 'night' WHEN hour({_TS}) <= 12 THEN 'morning'
      WHEN hour({_TS}) <= 18 THEN 'afternoon' ELSE 'evening' END AS part FROM orders_c""",
)
def day_part(spark, sf):
    return bindings.orders(spark, sf).select("order_id", time_of_day(F.hour(_TS)).alias("part"))


_FRAME_INPUTS = [
    *FITTED_COLUMNS,
    "seller_id",
    "freight_value",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "customer_state",
    "seller_state",
    "payment_installments",
]
_FRAME = ["seller_customer_distance_km", "price_vs_category_zscore", "payment_per_installment", "recency", "monetary"]


@query(
    "f15_feature_frame",
    _GEO
    + """, train AS (SELECT * FROM g WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'),
    st AS (SELECT product_category_name_english AS c, avg(price) AS m, coalesce(stddev_samp(price), 1.0) AS s
      FROM train WHERE product_category_name_english IS NOT NULL GROUP BY 1),
    o AS (SELECT avg(price) AS gm, stddev_samp(price) AS gs, quantile_cont(km, 0.5) AS gk, max(order_purchase_timestamp) AS last_at FROM train),
    cf AS (SELECT customer_unique_id, floor((epoch_us(any_value(last_at)) - epoch_us(max(order_purchase_timestamp))) / 86400000000.0::DOUBLE) AS recency,
      coalesce(sum(payment_value), 0.0::DOUBLE) AS monetary FROM train, o GROUP BY 1),
    fill AS (SELECT quantile_cont(recency, 0.5) AS fr, quantile_cont(monetary, 0.5) AS fm FROM cf),
    x AS (SELECT g.*, coalesce(km, gk) AS seller_customer_distance_km,
      (price - coalesce(m, gm)) / (coalesce(s, gs) + 1) AS price_vs_category_zscore,
      payment_value / (coalesce(payment_installments, 1) + 1) AS payment_per_installment,
      coalesce(cf.recency, fr) AS recency, coalesce(cf.monetary, fm) AS monetary
      FROM g LEFT JOIN st ON product_category_name_english = c LEFT JOIN cf USING (customer_unique_id), o, fill)
    SELECT order_id, order_item_id, seller_id, """
    + r(*_FRAME)
    + " FROM x",
)
def feature_frame(spark, sf):
    """The tables are joined once for the fit and the frame; a review's text is not kept with every item but joined by its order."""
    kept = wide_kept(spark, sf, *_FRAME_INPUTS)
    train = kept.where(F.col(_TS) < F.lit("1999-01-01").cast("timestamp"))
    model = FeatureModel(mean_coordinates(bindings.geolocation(spark, sf)), bindings.lexicon(spark, sf)).fit(train)
    texts = bindings.reviews(spark, sf).select("order_id", "review_comment_message")
    return rounded(model.transform(kept.join(texts, "order_id", "left")).select("order_id", "order_item_id", "seller_id", *_FRAME))


_SCALED = ["product_weight_g", "product_height_cm", "product_photos_qty"]


@query(
    "e1_standardise",
    W
    + ", f AS (SELECT product_id, "
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM products_c)) AS {c}" for c in _SCALED)
    + " FROM products_c), x AS (SELECT product_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _SCALED)
    + " FROM f) SELECT product_id, "
    + r(*_SCALED)
    + " FROM x",
)
def standardise(spark, sf):
    out = E.StandardScaler(_SCALED).fit_transform(bindings.products(spark, sf))
    return rounded(out.select("product_id", *_SCALED))


@query(
    "e2_one_hot",
    "SELECT event_id, "
    + ", ".join(f"CAST(event_type = '{t}' AS INT) AS event_type_{t}" for t in ("click", "error", "purchase", "signup", "view"))
    + " FROM events",
)
def one_hot(spark, sf):
    events = bindings.table(spark, sf, "events").select("event_id", "event_type")
    return E.OneHot(["event_type"]).fit(events).transform(events).drop("event_type")


@query("e3_preprocessor")
def preprocess(spark, sf):
    df = bindings.products(spark, sf).withColumn("is_large", (F.col("product_height_cm") > 15).cast("int"))
    model = E.fit_preprocessor(df, _SCALED, ["product_category_name"], ["is_large"])
    names = E.feature_names(model, df)
    from pyspark.ml.functions import vector_to_array

    cells = model.transform(df).select("product_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    table = F.array(*[F.lit(n) for n in names])
    named = cells.withColumn("feature", F.get(table, F.col("place")))
    return rounded(named.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation")))


_VARIANCE = ["is_satisfied", "is_late_delivery", "price", "review_score"]


@query(
    "e5_low_variance",
    W + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(var_pop({c}), 2) AS variance, var_pop({c}) > 0.01 AS kept FROM tw""" for c in _VARIANCE
    ),
)
def low_variance(spark, sf):
    return rounded(E.low_variance(wide(spark, sf), _VARIANCE), 2)


@query(
    "e6_correlated_columns",
    W
    + """SELECT 'delivery_delay_days' AS dropped, round(abs(corr(delivery_days, delivery_delay_days)), 4) AS max_correlation FROM tw""",
)
def correlated(spark, sf):
    names = ["price", "freight_value", "delivery_days", "delivery_delay_days", "review_score"]
    return rounded(E.correlated_columns(wide(spark, sf), names, 0.95))


@query("e8_principal_plane")
def plane(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = bindings.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    out, shares = E.principal_plane(vectors)
    xy = vector_to_array("components")
    return rounded(out.select("vec_id", xy[0].alias("x"), xy[1].alias("y"), F.lit(sum(shares)).alias("explained")))


@query(
    "e9_min_max",
    "SELECT event_id, round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 4) AS value FROM events",
)
def min_max(spark, sf):
    return rounded(E.min_max_scaled(bindings.table(spark, sf, "events"), ["value"]).select("event_id", "value"))


@query(
    "e9_robust",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, round((value - m) / (b - a), 4) AS value FROM events, q""",
)
def robust(spark, sf):
    return rounded(E.robust_scaled(bindings.table(spark, sf, "events"), ["value"]).select("event_id", "value"))


@query(
    "e10_frequency",
    "SELECT event_id, round(count(*) OVER (PARTITION BY event_type) / count(*) OVER (), 4) AS share FROM events",
)
def frequency(spark, sf):
    return rounded(E.frequency_encoded(bindings.table(spark, sf, "events"), "event_type", "share").select("event_id", "share"))


@query(
    "e10_target",
    """SELECT event_id, round((sum(value) OVER (PARTITION BY event_type) + 10 * avg(value) OVER ())
      / (count(*) OVER (PARTITION BY event_type) + 10), 4) AS event_type_target FROM events""",
)
def target(spark, sf):
    events = bindings.table(spark, sf, "events")
    return rounded(E.target_encoded(events, events, "event_type", "value").select("event_id", "event_type_target"))


_ORDER = ["view", "click", "signup", "purchase"]


@query(
    "e10_ordinal_binary",
    """WITH p AS (SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE -1 END AS k
      FROM events)
    SELECT event_id, k AS event_type_ordinal, CAST((k + 1) & 1 AS INT) AS event_type_bit0, CAST((k + 1) >> 1 & 1 AS INT) AS event_type_bit1,
      CAST((k + 1) >> 2 & 1 AS INT) AS event_type_bit2 FROM p""",
)
def ordinal(spark, sf):
    events = bindings.table(spark, sf, "events").select("event_id", "event_type")
    out = E.binary_encoded(E.ordinal_encoded(events, "event_type", _ORDER), "event_type", _ORDER)
    return out.drop("event_type")


_POWERS = [round(-2.0 + 0.1 * i, 1) for i in range(41)]


@query(
    "e11_box_cox",
    "WITH l AS ("
    + " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS p, ({p} - 1) * sum(ln(o_totalprice)) - count(*) / 2.0::DOUBLE * ln(var_pop("
        + ("ln(o_totalprice)" if p == 0 else f"(pow(o_totalprice, {p}::DOUBLE) - 1) / {p}::DOUBLE")
        + ")) AS score FROM orders"
        for p in _POWERS
    )
    + """) SELECT o_orderkey, round(CASE WHEN p = 0 THEN ln(o_totalprice) ELSE (pow(o_totalprice, p) - 1) / p END + 0.0000001::DOUBLE, 2) AS transformed
    FROM orders, (SELECT arg_max(p, score) AS p FROM l)""",
)
def box_cox(spark, sf):
    orders = bindings.table(spark, sf, "orders")
    power = E.box_cox_lambda(orders, "o_totalprice")
    return rounded(orders.select("o_orderkey", E.box_cox("o_totalprice", power).alias("transformed")), 2)


@query(
    "e11_quantile_uniform",
    "WITH q AS (SELECT unnest(range(101)) AS i, unnest(quantile_cont(value, ["
    + ", ".join(str(i / 100) for i in range(101))
    + """])) AS v FROM events), k AS (SELECT v, (min(i) + max(i)) / 200.0::DOUBLE AS lvl FROM q GROUP BY v),
    s AS (SELECT v, lvl, lead(v) OVER (ORDER BY v) AS next_v, lead(lvl) OVER (ORDER BY v) AS next_lvl FROM k)
    SELECT event_id, round(coalesce(lvl + (value - v) / (next_v - v) * (next_lvl - lvl), lvl), 4) AS level
    FROM events ASOF LEFT JOIN s ON events.value >= s.v""",
)
def quantile_uniform(spark, sf):
    out = E.quantile_uniform(bindings.table(spark, sf, "events"), "value", "level")
    return rounded(out.select("event_id", "level"))


@query("e12_variance_inflation")
def inflation(spark, sf):
    names = ["price", "freight_value", "delivery_days", "review_score", "product_weight_g"]
    return rounded(E.variance_inflation(wide(spark, sf), names))

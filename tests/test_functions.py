import math

import pytest
from pyspark.sql import functions as F

from shopsight.functions.calendar import calendar_columns, time_of_day
from shopsight.functions.commerce import payment_columns, product_columns
from shopsight.functions.geo import great_circle_km, region_of, same_place
from shopsight.functions.text import lexicon_sentiment, sentiment_label, text_columns
from shopsight.functions.values import clip, finite, flag, whole_days


def values(df):
    return [tuple(r) for r in df.collect()]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (3.0,), (50.0,)], "x double")
    assert values(df.select(clip("x", 0.0, 10.0))) == [(None,), (0.0,), (3.0,), (10.0,)]


def test_flag_of_unknown_is_zero(spark):
    df = spark.createDataFrame([(None,), (3,), (5,)], "x int")
    assert values(df.select(flag(F.col("x") >= 4))) == [(0,), (0,), (1,)]


def test_finite(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,), (None,)], "x double")
    assert values(df.select(finite("x"))) == [(None,), (None,), (1.0,), (None,)]


def test_whole_days_are_elapsed_not_calendar(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 23:00:00' a, timestamp'2024-01-03 01:00:00' b")
    assert values(df.select(whole_days("b", "a"))) == [(1,)]


def test_calendar(spark):
    # Sunday at the end of a month.
    df = spark.sql("SELECT timestamp'2024-03-31 06:30:00' ts")
    row = df.withColumns(calendar_columns("ts")).first()
    assert (row.order_hour, row.order_dayofweek, row.order_month, row.order_day, row.order_quarter) == (6, 6, 3, 31, 1)
    assert (row.is_weekend, row.is_month_start, row.is_month_end) == (1, 0, 1)
    assert row.order_hour_sin == pytest.approx(1.0) and row.order_hour_cos == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("hour,part", [(0, "night"), (6, "night"), (7, "morning"), (12, "morning"), (18, "afternoon"), (23, "evening")])
def test_time_of_day(spark, hour, part):
    assert values(spark.range(1).select(time_of_day(F.lit(hour)))) == [(part,)]


def test_distance(spark):
    df = spark.createDataFrame(
        [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 1.0, 1.0), (-23.5, -46.6, -22.9, -43.2)],
        "a double, b double, c double, d double",
    )
    there = [r[0] for r in df.select(great_circle_km("a", "b", "c", "d")).collect()]
    back = [r[0] for r in df.select(great_circle_km("c", "d", "a", "b")).collect()]
    assert there[0] == 0 and there[1] == pytest.approx(math.pi * 6371) and there[2] is None
    assert there[3] == pytest.approx(back[3]) and 300 < there[3] < 400


def test_region(spark):
    df = spark.createDataFrame([("sp",), ("ZZ",), (None,), ("DF",)], "s string")
    assert values(df.select(region_of("s"))) == [("SE",), ("unknown",), ("unknown",), ("CO",)]


def test_same_place_with_nulls(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, None)], "l string, r string")
    assert values(df.select(same_place("l", "r"))) == [(1,), (0,), (1,)]


def test_text_edge_cases(spark):
    texts = ["", "   ", "ÇÃO!?", "abc", None, "Two words !!"]
    df = spark.createDataFrame([(t,) for t in texts], "review_comment_message string")
    rows = df.select(*[c.alias(n) for n, c in text_columns("review_comment_message").items()]).collect()
    assert [r.has_review_comment for r in rows] == [0, 0, 1, 1, 0, 1]
    assert [r.review_caps_ratio for r in rows][:5] == [0.0, 0.0, 1.0, 0.0, 0.0]
    assert [r.review_word_count for r in rows] == [len((t or "").split()) for t in texts]
    assert [r.review_text_length for r in rows] == [len(t or "") for t in texts]
    assert (rows[2].review_exclamation_count, rows[2].review_question_count, rows[5].review_exclamation_count) == (1, 1, 2)


def test_sentiment(spark):
    words = spark.createDataFrame([("good", 1.0, 0.5), ("bad", -1.0, 1.0)], "word string, polarity double, subjectivity double")
    df = spark.createDataFrame([(1, "Good, good; BAD!"), (2, "nothing"), (3, None), (4, "")], "id int, t string")
    rows = {r.id: (r.sentiment_polarity, r.sentiment_subjectivity) for r in lexicon_sentiment(df, "id", "t", words).collect()}
    assert rows[1] == pytest.approx((1 / 3, 2 / 3)) and rows[2] == rows[3] == rows[4] == (0.0, 0.0)


def test_sentiment_label(spark):
    df = spark.createDataFrame([(-1.0,), (-0.1,), (0.0,), (0.1,), (1.0,)], "p double")
    assert [r[0] for r in df.select(sentiment_label("p")).collect()] == ["negative", "negative", "neutral", "neutral", "positive"]


def test_payment_defaults(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 1), (60.0, 6)], "payment_value double, payment_installments int")
    rows = df.select(*[c.alias(n) for n, c in payment_columns().items()]).collect()
    assert [r.payment_per_installment for r in rows] == [50.0, 50.0, pytest.approx(60 / 7)]
    assert [(r.is_full_payment, r.is_high_installment) for r in rows] == [(1, 0), (1, 0), (0, 1)]


def test_product_ratios(spark):
    df = spark.createDataFrame(
        [(10.0, 4.0, 2.0, 3.0, 500.0, 0.0), (1.0, 0.0, 0.0, 0.0, None, None)],
        "price double, product_length_cm double, product_height_cm double, product_width_cm double, product_weight_g double, freight_value double",
    )
    a, b = df.select(*[c.alias(n) for n, c in product_columns().items()]).collect()
    assert (a.product_volume_cm3, a.product_density) == (24.0, 20.0)
    assert a.price_per_kg == pytest.approx(10 / 0.6) and a.freight_ratio == 0.0
    assert b.product_density is None and b.freight_ratio is None

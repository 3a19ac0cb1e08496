"""The order-level feature frame: fitted on train, applied to every split in one projection chain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from shopsight.functions.calendar import add_calendar_features
from shopsight.functions.commerce import payment_columns, product_columns, relative_price_columns
from shopsight.functions.text import add_text_features, lexicon_sentiment
from shopsight.operators.aggregates import category_price_stats, customer_behaviour
from shopsight.operators.joins import attach_coordinates, attach_with_fill, distance_column, geographic_columns
from shopsight.operators.ranking import medians
from shopsight.sources.writers import write_metadata, write_splits, write_table

# Feature groups of the order frame and the customer frame.
NUMERICAL_FEATURES = [
    "price",
    "freight_value",
    "payment_value",
    "payment_installments",
    "product_weight_g",
    "product_volume_cm3",
    "product_photos_qty",
    "seller_customer_distance_km",
    "freight_ratio",
    "price_vs_category_zscore",
    "review_text_length",
    "review_word_count",
    "review_caps_ratio",
    "review_sentiment_polarity",
    "review_sentiment_subjectivity",
    "order_hour_sin",
    "order_hour_cos",
    "order_dayofweek_sin",
    "order_dayofweek_cos",
    "payment_per_installment",
]
CATEGORICAL_FEATURES = [
    "customer_state",
    "seller_state",
    "customer_region",
    "seller_region",
    "product_category_name_english",
    "payment_type",
]
BINARY_FEATURES = [
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "is_same_state",
    "is_full_payment",
    "is_high_installment",
    "has_review_comment",
    "is_late_delivery",
]
FITTED_COLUMNS = [
    "customer_unique_id",
    "order_id",
    "order_item_id",
    "order_purchase_timestamp",
    "customer_zip_code_prefix",
    "seller_zip_code_prefix",
    "product_category_name_english",
    "price",
    "payment_value",
    "review_score",
    "delivery_days",
    "is_late_delivery",
]
RFM_FEATURES = ["recency", "frequency", "monetary", "avg_order_value", "monetary_per_day"]
BEHAVIOUR_FEATURES = [
    "avg_review_score",
    "avg_delivery_days",
    "late_delivery_rate",
    "avg_price",
    "total_items",
]


def add_geographic_features(
    df: DataFrame, geo: DataFrame, median_km: float | None = None, regions: Mapping | None = None
) -> DataFrame:
    """Coordinates, distance (missing ones get the median given, else of this frame), regions."""
    placed = attach_coordinates(df, geo)
    if median_km is None:
        median_km = medians(placed.select(distance_column().alias("km")), ["km"])["km"]
    return placed.withColumns(geographic_columns(median_km, regions))


def price_moments(df: DataFrame) -> tuple[float | None, float | None]:
    return tuple(df.agg(F.avg("price"), F.stddev_samp("price")).first())


def add_product_features(
    df: DataFrame, stats: DataFrame | None = None, overall: tuple | None = None
) -> tuple[DataFrame, DataFrame]:
    """Product ratios and prices relative to the category; unknown categories use overall moments."""
    stats = category_price_stats(df) if stats is None else stats
    mean, std = overall if overall is not None else price_moments(df)
    joined = attach_with_fill(
        df.withColumns(product_columns()),
        stats,
        "product_category_name_english",
        {"category_price_mean": mean, "category_price_std": std},
    )
    return joined.withColumns(relative_price_columns()), stats


def add_sentiment(df: DataFrame, id_column: str, text: str, lexicon: DataFrame | None) -> DataFrame:
    """Neutral without a lexicon. Each text is scored once per id, not once per row."""
    names = {"sentiment_polarity": "review_sentiment_polarity", "sentiment_subjectivity": "review_sentiment_subjectivity"}
    if lexicon is None:
        return df.withColumns({n: F.lit(0.0) for n in names.values()})
    texts = df.where(F.col(text).isNotNull()).groupBy(id_column).agg(F.max(text).alias(text))
    scores = lexicon_sentiment(texts, id_column, text, lexicon).drop(text).withColumnsRenamed(names)
    return df.join(scores, id_column, "left").na.fill(0.0, list(names.values()))


@dataclass
class FeatureModel:
    """What training shows: category prices, overall price, median distance, the customer table."""

    geo: DataFrame
    lexicon: DataFrame | None = None
    regions: Mapping | None = None
    stats: DataFrame | None = None
    customers: DataFrame | None = None
    overall: tuple | None = None
    median_km: float | None = None
    rfm_fill: dict[str, float] = field(default_factory=dict)

    def fit(self, train: DataFrame, reference: datetime | str | None = None) -> FeatureModel:
        """Several small aggregations over the columns they need, which are kept for the time being."""
        narrow = train.select(*FITTED_COLUMNS).persist()
        distances = attach_coordinates(narrow, self.geo).select(distance_column().alias("km"))
        self.median_km = medians(distances, ["km"], keep=False)["km"]
        self.overall = price_moments(narrow)
        self.stats = category_price_stats(narrow).persist()
        self.customers = customer_behaviour(narrow, reference).persist()
        self.rfm_fill = medians(self.customers, RFM_FEATURES, keep=False)
        self.stats.count()
        narrow.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = add_calendar_features(df)
        out = add_geographic_features(out, self.geo, self.median_km, self.regions)
        out, _ = add_product_features(out, self.stats, self.overall)
        out = add_sentiment(add_text_features(out), "order_id", "review_comment_message", self.lexicon)
        out = out.withColumns(payment_columns())
        return attach_with_fill(out, self.customers, "customer_unique_id", self.rfm_fill)


def save_features(model: FeatureModel, featured: DataFrame, uri: str) -> None:
    """Featured splits, customer table, category statistics and the feature names."""
    write_splits(featured, f"{uri}/featured")
    write_table(model.customers, f"{uri}/customers")
    write_table(model.stats, f"{uri}/category_stats", "csv")
    names = {
        "numerical": NUMERICAL_FEATURES,
        "categorical": CATEGORICAL_FEATURES,
        "binary": BINARY_FEATURES,
        "rfm": RFM_FEATURES,
        "behaviour": BEHAVIOUR_FEATURES,
    }
    write_metadata(featured.sparkSession, names, f"{uri}/feature_names")

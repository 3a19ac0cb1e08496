"""Targets, type correction and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from shopsight.functions.values import elapsed_days, flag

# Target types by column.
COLUMN_TYPES = {
    "order_status": "string",
    "customer_state": "string",
    "seller_state": "string",
    "product_category_name": "string",
    "product_category_name_english": "string",
    "payment_type": "string",
    "order_item_id": "int",
    "payment_installments": "int",
    "payment_methods_count": "int",
    "product_photos_qty": "int",
    "is_satisfied": "int",
    "is_late_delivery": "int",
}

# Columns that tell the answer and must not be features of the satisfaction model.
LEAKAGE_COLUMNS = [
    "review_score",
    "review_id",
    "order_id",
    "customer_id",
    "customer_unique_id",
    "product_id",
    "seller_id",
    "is_satisfied",
]


def add_targets(df: DataFrame, threshold: int = 4, null_policy: str = "zero") -> DataFrame:
    """Satisfaction, delivery time, lateness and delay.

    null_policy 'zero' makes an unknown comparison 0; 'propagate' keeps it null.
    """
    if null_policy not in ("zero", "propagate"):
        raise ValueError(f"unknown null_policy: {null_policy}")
    delivered, expected = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    binary = flag if null_policy == "zero" else (lambda c: c.cast("int"))
    return df.withColumns(
        {
            "is_satisfied": binary(F.col("review_score") >= threshold),
            "delivery_days": elapsed_days(delivered, "order_purchase_timestamp"),
            "is_late_delivery": binary(delivered > expected),
            "delivery_delay_days": elapsed_days(delivered, expected),
        }
    )


def correct_types(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Cast the listed columns that exist; values that do not fit become null."""
    types = COLUMN_TYPES if types is None else types
    present = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def select_features(df: DataFrame, features: Sequence[str], excluded: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """The feature columns that exist, in order; refuses a feature that would leak the target."""
    leaking = [c for c in features if c in excluded]
    if leaking:
        raise ValueError(f"features leak the target: {leaking}")
    return df.select(*[c for c in features if c in df.columns])


def drop_leakage(df: DataFrame, excluded: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """Everything except leaking columns and raw timestamps."""
    dates = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.drop(*excluded, *dates)


def logical_violations(df: DataFrame):
    """Conditions a correct order cannot meet, by name."""
    return {
        "delivered_before_purchase": F.coalesce(
            F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"), F.lit(False)
        ),
        "price_not_positive": F.coalesce(F.col("price") <= 0, F.lit(False)),
    }


def logical_filter(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without violations, one row of violation counts)."""
    broken = logical_violations(df)
    keep = F.lit(True)
    for condition in broken.values():
        keep = keep & ~condition
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in broken.items()])
    return df.where(keep), counts


def with_target(df: DataFrame, target: str = "delivery_days") -> DataFrame:
    """Rows whose target is known."""
    return df.where(F.col(target).isNotNull())

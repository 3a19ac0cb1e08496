"""Product and payment expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shopsight.functions.values import flag


def product_columns() -> dict[str, Column]:
    """Shape and price ratios. The denominators carry a constant, so they never reach zero."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    kilograms = F.col("product_weight_g") / 1000
    return {
        "product_volume_cm3": volume,
        "product_density": F.col("product_weight_g") / (volume + 1),
        "price_per_kg": F.col("price") / (kilograms + 0.1),
        "freight_ratio": F.col("freight_value") / (F.col("price") + 1),
    }


def relative_price_columns() -> dict[str, Column]:
    gap = F.col("price") - F.col("category_price_mean")
    return {
        "price_vs_category_mean": gap,
        "price_vs_category_zscore": gap / (F.col("category_price_std") + 1),
    }


def payment_columns() -> dict[str, Column]:
    """A missing number of installments counts as one."""
    installments = F.coalesce(F.col("payment_installments"), F.lit(1))
    return {
        "payment_per_installment": F.col("payment_value") / (installments + 1),
        "is_full_payment": flag(installments <= 1),
        "is_high_installment": flag(installments >= 6),
    }

"""Raw tables to clean, split data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from shopsight.operators.joins import merge_tables
from shopsight.operators.quality import DEFAULT_RULES, CleaningModel, Rule, clean_training, validate
from shopsight.operators.split import apply_split, assign_time_split
from shopsight.operators.targets import add_targets
from shopsight.sources.writers import write_splits, write_table


@dataclass
class Prepared:
    data: DataFrame  # all splits, with a `split` column
    model: CleaningModel

    def part(self, split: str) -> DataFrame:
        return self.data.where(F.col("split") == split).drop("split")


def prepare(
    tables: Mapping[str, DataFrame],
    ratios: Sequence[float] = (0.70, 0.15, 0.15),
    threshold: int = 4,
    check: bool = True,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> Prepared:
    """Split orders by time first, then join, add targets, fit the cleaning on train and apply it to all."""
    assigned = assign_time_split(tables["orders"], *ratios)
    merged = add_targets(merge_tables(tables), threshold)
    data = apply_split(merged, assigned.select("order_id", "split"))
    train, model = clean_training(data.where(F.col("split") == "train"), check=check, rules=rules)
    rest = model.transform(data.where(F.col("split") != "train"))
    if check:
        validate(rest, rules)
    return Prepared(train.unionByName(rest), model)


def save_prepared(prepared: Prepared, uri: str) -> None:
    write_splits(prepared.data, f"{uri}/splits")
    write_table(prepared.model.to_table(prepared.data.sparkSession), f"{uri}/cleaning", "json")

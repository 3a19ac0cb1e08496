"""Missing values, outliers and declarative validation. Fitting and applying are separate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shopsight.functions.values import clip
from shopsight.operators.ranking import ROWS_PER_RANGE, cut_ranges, null_safe_left, quantiles
from shopsight.operators.targets import correct_types

STRATEGIES = ("drop", "mean", "median", "mode", "constant", "keep")

# How each column of the analysis frame is completed.
DEFAULT_STRATEGIES: dict[str, tuple[str, object]] = {
    "review_comment_title": ("keep", None),
    "review_comment_message": ("keep", None),
    "order_delivered_customer_date": ("keep", None),
    "order_delivered_carrier_date": ("keep", None),
    "order_approved_at": ("keep", None),
    "delivery_days": ("keep", None),
    "delivery_delay_days": ("keep", None),
    "is_late_delivery": ("keep", None),
    "is_satisfied": ("keep", None),
    "product_weight_g": ("median", None),
    "product_length_cm": ("median", None),
    "product_height_cm": ("median", None),
    "product_width_cm": ("median", None),
    "product_photos_qty": ("median", None),
    "product_name_lenght": ("median", None),
    "product_description_lenght": ("median", None),
    "product_category_name": ("constant", "unknown"),
    "product_category_name_english": ("constant", "unknown"),
}

# Columns whose tails are pulled in.
DEFAULT_OUTLIER_COLUMNS = [
    "price",
    "freight_value",
    "payment_value",
    "payment_installments",
    "delivery_days",
    "delivery_delay_days",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]


def most_frequent(df: DataFrame, column: str):
    """The most frequent value, lowest on ties. Values are counted by a shuffle, never in one buffer."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column)))).first()[0]


@dataclass
class Imputer:
    """Completes columns by strategy; `strategies` maps a column to (strategy, constant or None)."""

    strategies: Mapping[str, tuple[str, object]] = field(default_factory=lambda: dict(DEFAULT_STRATEGIES))
    fills: dict[str, object] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Imputer:
        present = {c: s for c, s in self.strategies.items() if c in df.columns}
        unknown = [s for s, _ in present.values() if s not in STRATEGIES]
        if unknown:
            raise ValueError(f"unknown strategy: {unknown[0]}")

        def having(strategy: str) -> list[str]:
            return [c for c, s in present.items() if s[0] == strategy]

        fills: dict[str, object] = {c: present[c][1] for c in having("constant")}
        middle = quantiles(df, having("median"), [0.5])
        fills.update({c: q[0] for c, q in middle.items() if q})
        if having("mean"):
            fills.update(df.agg(*[F.avg(c).alias(c) for c in having("mean")]).first().asDict())
        fills.update({c: most_frequent(df, c) for c in having("mode")})
        self.fills = {c: v for c, v in fills.items() if v is not None}
        return self

    def transform(self, df: DataFrame, drop: bool = True) -> DataFrame:
        """`drop=False` replays only the fill values, as for rows that must all be scored."""
        dropped = [c for c, s in self.strategies.items() if s[0] == "drop" and c in df.columns]
        if drop and dropped:
            df = df.dropna(subset=dropped)
        filled = {
            c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.fills.items() if c in df.columns
        }
        return df.withColumns(filled) if filled else df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


@dataclass
class Winsorizer:
    """Pulls values outside two fitted percentiles to those percentiles."""

    lower: float = 0.01
    upper: float = 0.99
    columns: Sequence[str] = field(default_factory=lambda: list(DEFAULT_OUTLIER_COLUMNS))
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Winsorizer:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        usable = [c for c in self.columns if isinstance(kinds.get(c), T.NumericType)]
        fitted = quantiles(df, usable, [self.lower, self.upper])
        self.bounds = {c: (q[0], q[1]) for c, q in fitted.items() if q}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        clipped = {c: clip(c, lo, hi) for c, (lo, hi) in self.bounds.items() if c in df.columns}
        return df.withColumns(clipped) if clipped else df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def winsorize(df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    return Winsorizer(lower, upper, [column]).fit_transform(df)


@dataclass
class CleaningModel:
    """Everything the cleaning of new rows needs, storable as one small table."""

    imputer: Imputer | None = None
    winsorizer: Winsorizer | None = None

    def transform(self, df: DataFrame, replay_drop: bool = False) -> DataFrame:
        """Types, fill values, bounds; rows are neither dropped (unless asked) nor validated."""
        df = correct_types(df)
        if self.imputer:
            df = self.imputer.transform(df, drop=replay_drop)
        if self.winsorizer:
            df = self.winsorizer.transform(df)
        return df

    def to_table(self, spark: SparkSession) -> DataFrame:
        """One row per fitted column: column, strategy, fill_number, fill_text, low, high."""
        strategies = dict(self.imputer.strategies) if self.imputer else {}
        fills = self.imputer.fills if self.imputer else {}
        bounds = self.winsorizer.bounds if self.winsorizer else {}
        rows = []
        for c in dict.fromkeys([*strategies, *bounds]):
            fill = fills.get(c)
            text = fill if isinstance(fill, str) else None
            number = float(fill) if fill is not None and text is None else None
            low, high = bounds.get(c, (None, None))
            rows.append((c, strategies.get(c, (None, None))[0], number, text, low, high))
        schema = "column string, strategy string, fill_number double, fill_text string, low double, high double"
        return spark.createDataFrame(rows, schema)

    @staticmethod
    def from_table(table: DataFrame) -> CleaningModel:
        imputer, winsorizer = Imputer({}), Winsorizer(columns=[])
        for r in table.collect():
            if r["strategy"]:
                imputer.strategies[r["column"]] = (r["strategy"], r["fill_text"])
            fill = r["fill_text"] if r["fill_text"] is not None else r["fill_number"]
            if fill is not None:
                imputer.fills[r["column"]] = fill
            if r["low"] is not None:
                winsorizer.bounds[r["column"]] = (r["low"], r["high"])
        return CleaningModel(imputer, winsorizer)


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy. Unset parts are not checked."""

    column: str
    kind: str | None = None  # 'string', 'number', 'integer'
    nullable: bool = True
    allowed: tuple | None = None
    low: float | None = None
    high: float | None = None

    def checks(self) -> dict[str, Column]:
        """Violation conditions by check name."""
        c = F.col(self.column)
        out = {}
        if not self.nullable:
            out["not_null"] = c.isNull()
        if self.allowed is not None:
            out["allowed"] = c.isNotNull() & ~c.isin(list(self.allowed))
        if self.low is not None:
            out["at_least"] = F.coalesce(c < self.low, F.lit(False))
        if self.high is not None:
            out["at_most"] = F.coalesce(c > self.high, F.lit(False))
        return out

    def type_ok(self, kind: T.DataType) -> bool:
        families = {"string": T.StringType, "number": T.NumericType, "integer": T.IntegralType}
        return self.kind is None or isinstance(kind, families[self.kind])


# The rules of the analysis frame.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
DEFAULT_RULES = [
    Rule("order_id", "string", nullable=False),
    Rule("customer_id", "string", nullable=False),
    Rule("order_status", "string", nullable=False, allowed=ORDER_STATUSES),
    Rule("price", "number", low=0),
    Rule("freight_value", "number", low=0),
    Rule("payment_value", "number", low=0),
    Rule("review_score", "number", low=1, high=5),
    Rule("is_satisfied", "integer", allowed=(0, 1)),
    Rule("delivery_days", "number"),
    Rule("is_late_delivery", "integer", allowed=(0, 1)),
    Rule("product_weight_g", "number", low=0),
    Rule("product_length_cm", "number", low=0),
    Rule("product_height_cm", "number", low=0),
    Rule("product_width_cm", "number", low=0),
]


class ValidationError(ValueError):
    """Carries every failed check, not only the first."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__("; ".join(f"{c}: {check} ({n})" for c, check, n, _ in failures))


def violations(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """All checks in one pass: column, check, failures, and one failing value as a sample."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = "column string, check string, failures long, sample string"
    structural, tests = [], []
    for rule in rules:
        if rule.column not in kinds:
            structural.append((rule.column, "present", 1, None))
        elif not rule.type_ok(kinds[rule.column]):
            structural.append((rule.column, "type", 1, kinds[rule.column].simpleString()))
        else:
            tests += [(rule.column, name, bad) for name, bad in rule.checks().items()]
    report = df.sparkSession.createDataFrame(structural, schema)
    if not tests:
        return report
    wide = df.agg(
        *[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(tests)],
        *[F.min(F.when(bad, F.col(c).cast("string"))).alias(f"v{i}") for i, (c, _, bad) in enumerate(tests)],
    )
    items = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(name).alias("check"),
            F.col(f"n{i}").alias("failures"),
            F.col(f"v{i}").alias("sample"),
        )
        for i, (c, name, _) in enumerate(tests)
    ]
    return wide.select(F.inline(F.array(*items))).unionByName(report)


def validate(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> bool:
    """True, or a ValidationError listing every check that failed."""
    failed = violations(df, rules).where(F.col("failures") > 0).collect()
    if failed:
        raise ValidationError([tuple(r) for r in failed])
    return True


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the reasons) for a batch to be scored."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    absent = [r.column for r in rules if r.column not in kinds]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    wrong = [r.column for r in rules if not r.type_ok(kinds[r.column])]
    if wrong:
        raise ValueError(f"columns of the wrong type: {wrong}")
    reasons = [
        F.when(bad, F.lit(f"{r.column}:{name}")) for r in rules for name, bad in r.checks().items()
    ]
    marked = df.withColumn("reasons", F.array_compact(F.array(*reasons)))
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def clean_training(
    df: DataFrame,
    impute: bool = True,
    winsorize: bool = True,
    check: bool = True,
    strategies: Mapping | None = None,
    outlier_columns: Sequence[str] | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> tuple[DataFrame, CleaningModel]:
    """Types, missing values, tails, validation; returns the frame and what was fitted."""
    df = correct_types(df)
    model = CleaningModel()
    if impute:
        model.imputer = Imputer(dict(strategies or DEFAULT_STRATEGIES)).fit(df)
        df = model.imputer.transform(df)
    if winsorize:
        model.winsorizer = Winsorizer(columns=list(outlier_columns or DEFAULT_OUTLIER_COLUMNS)).fit(df)
        df = model.winsorizer.transform(df)
    if check:
        validate(df, rules)
    return df, model


def drop_repeats(df: DataFrame, key: Sequence[str], keep_first_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order.

    An aggregation keeps the smallest row of each key on the map side, so a key with a third of all rows
    sends one row per task.
    """
    rest = [c for c in df.columns if c not in key and c not in keep_first_by]
    order = [c for c in keep_first_by if c not in key]
    best = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(best).select(*key, "_row.*").select(*df.columns)


def repeats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row and how many."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def zscore_outliers(
    df: DataFrame, columns: Sequence[str], threshold: float = 3.0, treatment: str = "keep"
) -> DataFrame:
    """Rows beyond `threshold` sample deviations: 'keep' flags, 'remove' drops, 'cap' clamps, 'transform' log1p."""
    if treatment not in ("keep", "remove", "cap", "transform"):
        raise ValueError(f"unknown treatment: {treatment}")
    fit = df.agg(
        *[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_samp(c).alias(f"{c}_s") for c in columns]
    ).first()
    if treatment == "transform":
        return df.withColumns({c: F.signum(c) * F.log1p(F.abs(c)) for c in columns})
    bounds = {
        c: (fit[f"{c}_m"] - threshold * fit[f"{c}_s"], fit[f"{c}_m"] + threshold * fit[f"{c}_s"])
        for c in columns
        if fit[f"{c}_s"] is not None
    }
    if treatment == "cap":
        return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})
    outside = {c: F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)) for c, (lo, hi) in bounds.items()}
    if treatment == "remove":
        return df.where(~reduce(lambda a, b: a | b, outside.values(), F.lit(False)))
    return df.withColumns({f"{c}_outlier": o.cast("int") for c, o in outside.items()})


def forward_fill(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Carry the last known value forward within each partition.

    The first order column (numeric or timestamp) is cut into ranges. A window fills inside (partition,
    range); what a range inherits comes from a window over one summary row per range, so one long
    partition is filled by many tasks.
    """
    keys = [*partition_by, "_range"]
    frame = cut_ranges(df, order_by[0], "_range", rows_per_range)
    order = F.struct(*order_by)
    last = {c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_in_{c}") for c in columns}
    summary = frame.groupBy(*keys).agg(*last.values())
    earlier = Window.partitionBy(*partition_by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*keys, *[F.last(f"_in_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns])
    here = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    filled = null_safe_left(frame, carried, keys).withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(here), F.col(f"_in_{c}")) for c in columns}
    )
    return filled.select(*df.columns)

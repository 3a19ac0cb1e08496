"""Scaling, encoding and selecting features. Fitted objects hold plain numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.values import finite
from shopsight.operators.profile import correlation_pairs
from shopsight.operators.ranking import medians, null_safe_left, quantiles


@dataclass
class StandardScaler:
    """Median fill, then zero mean and unit population deviation; constant columns are only centred."""

    columns: Sequence[str]
    fill: bool = True
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)

    def _filled(self, c: str) -> Column:
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(self.medians[c])) if self.medians.get(c) is not None else x

    def fit(self, df: DataFrame) -> StandardScaler:
        if self.fill:
            self.medians = medians(df, self.columns)
        row = df.agg(
            *[F.avg(self._filled(c)).alias(f"{c}_m") for c in self.columns],
            *[F.stddev_pop(self._filled(c)).alias(f"{c}_s") for c in self.columns],
        ).first()
        self.means = {c: row[f"{c}_m"] for c in self.columns}
        self.scales = {c: (row[f"{c}_s"] or 1.0) for c in self.columns}
        return self

    def column(self, c: str) -> Column:
        return (self._filled(c) - F.lit(self.means[c])) / F.lit(self.scales[c])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.columns})

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def min_max_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    fit = df.agg(*[F.min(c).alias(f"{c}_l") for c in columns], *[F.max(c).alias(f"{c}_h") for c in columns]).first()
    out = {}
    for c in columns:
        low, high = fit[f"{c}_l"], fit[f"{c}_h"]
        width = (high - low) if low is not None and high != low else 1.0
        out[c] = (F.col(c) - F.lit(low)) / F.lit(float(width))
    return df.withColumns(out)


def robust_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distance from the median in interquartile ranges."""
    fitted = quantiles(df, columns, [0.25, 0.5, 0.75])
    out = {}
    for c, q in fitted.items():
        if q:
            out[c] = (F.col(c) - F.lit(q[1])) / F.lit((q[2] - q[0]) or 1.0)
    return df.withColumns(out)


@dataclass
class OneHot:
    """One 0/1 column per level seen in training, levels in order; null counts as 'unknown'.

    Columns are for people: their number is that of the levels. `fit_preprocessor` encodes any number of levels
    as one sparse vector.
    """

    columns: Sequence[str]
    levels: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> OneHot:
        for c in self.columns:
            seen = df.select(F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("v")).distinct()
            self.levels[c] = sorted(r["v"] for r in seen.collect())
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        wide = {}
        for c in self.columns:
            value = F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
            wide.update({f"{c}_{level}": (value == level).cast("int") for level in self.levels[c]})
        return df.withColumns(wide)


def _number(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def scaling_stage(scaler: StandardScaler, others: Sequence[str] = (), logs: Sequence[str] = ()) -> SQLTransformer:
    """The fitted scaling as a stage that MLlib can save: adds <column>_z beside the inputs."""
    exprs = list(others)
    for c in scaler.columns:
        source = c.removesuffix("_log") if c in logs else c
        value = f"log1p(`{source}`)" if c in logs else f"CAST(`{c}` AS DOUBLE)"
        if scaler.medians.get(c) is not None:
            value = f"coalesce({value}, {_number(scaler.medians[c])})"
        exprs.append(f"({value} - {_number(scaler.means[c])}) / {_number(scaler.scales[c])} AS `{c}_z`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def fit_preprocessor(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), binary: Sequence[str] = ()
) -> PipelineModel:
    """Scaled numbers, one-hot categories (no level left out, unseen ones all zero), binaries as they are.

    The result adds the vector column 'features'; it can be saved and put in front of any estimator.
    """
    numeric, categorical, binary = list(numeric), list(categorical), list(binary)
    others = [f"coalesce(CAST(`{c}` AS STRING), 'unknown') AS `{c}_cat`" for c in categorical]
    others += [f"CAST(`{c}` AS DOUBLE) AS `{c}_bin`" for c in binary]
    stages = [scaling_stage(StandardScaler(numeric).fit(df), others)]
    if categorical:
        indexed, hot = [f"{c}_index" for c in categorical], [f"{c}_hot" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=[f"{c}_cat" for c in categorical],
                outputCols=indexed,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True))
    inputs = [f"{c}_z" for c in numeric] + [f"{c}_hot" for c in categorical] + [f"{c}_bin" for c in binary]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(df)


def feature_names(model: PipelineModel, df: DataFrame, output: str = "features") -> list[str]:
    """Names of the vector positions, from the attributes of the vector column."""
    attrs = model.transform(df.limit(0)).schema[output].metadata["ml_attr"]["attrs"]
    names = [name for _, name in sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)]
    return [n.replace("_hot_", "_").removesuffix("_z").removesuffix("_bin") for n in names]


def low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Population variance of each column and whether it is kept."""
    wide = df.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)]
    table = wide.select(F.inline(F.array(*items)))
    return table.withColumn("kept", F.coalesce(F.col("variance") > threshold, F.lit(False)))


def drop_low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    dropped = [r["column"] for r in low_variance(df, columns, threshold).where("not kept").collect()]
    return df.drop(*dropped)


def correlated_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Columns that correlate above the threshold with any column before them."""
    pairs = correlation_pairs(df, columns).where(F.abs("correlation") > threshold)
    return pairs.groupBy(F.col("feature_2").alias("dropped")).agg(
        F.max(F.abs("correlation")).alias("max_correlation")
    )


def drop_correlated(df: DataFrame, columns: Sequence[str], threshold: float = 0.95) -> tuple[DataFrame, list[str]]:
    found = {r["dropped"] for r in correlated_columns(df, columns, threshold).collect()}
    dropped = [c for c in columns if c in found]
    return df.drop(*dropped), dropped


def principal_plane(vectors: DataFrame, k: int = 2, features: str = "features") -> tuple[DataFrame, list[float]]:
    """Centred rows on the first k components (column components) and the components' variance shares.

    The covariance is gathered in one distributed pass (its size is that of the features squared) and split on the
    driver; a component's largest loading is positive, so that the result has one sign.
    """
    stats = vectors.agg(Summarizer.metrics("mean", "std").summary(F.col(features)).alias("s")).first()["s"]
    mean, deviation = stats["mean"].toArray(), stats["std"].toArray()
    correlation = np.nan_to_num(Correlation.corr(vectors, features).first()[0].toArray())
    np.fill_diagonal(correlation, 1.0)
    values, loadings = np.linalg.eigh(correlation * np.multiply.outer(deviation, deviation))
    order = np.argsort(-values)[:k]
    axes = []
    for column in order:
        axis = loadings[:, column]
        axes.append(axis * np.sign(axis[np.abs(axis).argmax()]))
    x = vector_to_array(features)
    dot = lambda axis: F.aggregate(
        F.zip_with(x, F.lit([float(v) for v in axis]), lambda a, b: a * b), F.lit(-float(mean @ axis)), lambda s, v: s + v
    )
    projected = vectors.withColumn("components", array_to_vector(F.array(*[dot(axis) for axis in axes])))
    total = float(values.sum()) or 1.0
    return projected, [float(values[c]) / total for c in order]


def frequency_encoded(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Share of rows holding the value."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    shares = counts.join(total).select(F.col(column).alias("_value"), (F.col("_n") / F.col("_all")).alias(output or f"{column}_frequency"))
    return df.join(shares, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def target_encoding(df: DataFrame, column: str, target: str, smoothing: float = 10.0) -> DataFrame:
    """Per value: (sum + smoothing x overall mean) / (count + smoothing)."""
    overall = df.agg(F.avg(target).alias("_mean"))
    stats = df.groupBy(column).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    encoded = (F.col("_s") + F.col("_mean") * smoothing) / (F.col("_n") + smoothing)
    return stats.join(overall).select(column, encoded.alias(f"{column}_target"))


def target_encoded(train: DataFrame, df: DataFrame, column: str, target: str, smoothing: float = 10.0) -> DataFrame:
    """Encode `df` with what `train` shows; unseen values get the training mean."""
    mean = train.agg(F.avg(target)).first()[0]
    name = f"{column}_target"
    joined = null_safe_left(df, target_encoding(train, column, target, smoothing), [column])
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(mean)))


def ordinal_encoded(df: DataFrame, column: str, order: Sequence[str], output: str | None = None) -> DataFrame:
    """Position in the given order; -1 when the value is not listed."""
    expr = F.lit(-1)
    for i, value in reversed(list(enumerate(order))):
        expr = F.when(F.col(column) == value, i).otherwise(expr)
    return df.withColumn(output or f"{column}_ordinal", expr)


def binary_encoded(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Bits of the 1-based position among the levels; an unlisted value has no bit set."""
    ordered = ordinal_encoded(df, column, levels, "_position").withColumn("_position", F.col("_position") + 1)
    bits = max(1, len(levels).bit_length())
    wide = {
        f"{column}_bit{b}": F.shiftright("_position", b).bitwiseAND(F.lit(1)).cast("int") for b in range(bits)
    }
    return ordered.withColumns(wide).drop("_position")


def log_transformed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_log": F.log1p(c) for c in columns})


def box_cox_lambda(df: DataFrame, column: str, grid: Sequence[float] | None = None) -> float:
    """The grid value with the highest likelihood for positive data: one aggregation for all of them."""
    grid = list(grid if grid is not None else np.round(np.arange(-2.0, 2.01, 0.1), 1))
    positive = df.where(F.col(column) > 0)
    logs = F.log(column)
    row = positive.agg(
        F.count("*").alias("n"),
        F.sum(logs).alias("s"),
        *[F.var_pop(box_cox(column, float(g))).alias(f"v{i}") for i, g in enumerate(grid)],
    ).first()
    likelihood = [
        (float(g) - 1) * row["s"] - row["n"] / 2 * np.log(row[f"v{i}"]) if row[f"v{i}"] else -np.inf
        for i, g in enumerate(grid)
    ]
    return float(grid[int(np.argmax(likelihood))])


def box_cox(column: Column | str, power: float) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.log(c) if abs(power) < 1e-9 else (F.pow(c, F.lit(power)) - 1) / F.lit(power)


def quantile_uniform(df: DataFrame, column: str, output: str, points: int = 101) -> DataFrame:
    """Map to [0, 1] by linear interpolation between fitted quantiles."""
    q = quantiles(df, [column], list(np.linspace(0, 1, points)))[column]
    knots = sorted(set(q))
    level = {v: (q.index(v) + len(q) - 1 - q[::-1].index(v)) / 2 / (points - 1) for v in knots}
    x = F.col(column)
    expr = F.when(x <= knots[0], level[knots[0]])
    for a, b in zip(knots, knots[1:]):
        inside = F.lit(level[a]) + (x - a) / (b - a) * (level[b] - level[a])
        expr = expr.when(x < b, inside)
    return df.withColumn(output, F.when(x.isNotNull(), expr.otherwise(level[knots[-1]])))


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Diagonal of the inverse correlation matrix (columns squared numbers reach the driver)."""
    p = len(columns)
    place = {c: i for i, c in enumerate(columns)}
    matrix = np.eye(p)
    complete = df.select(*[finite(c).alias(c) for c in columns]).dropna()
    for r in correlation_pairs(complete, columns).collect():
        i, j = place[r["feature_1"]], place[r["feature_2"]]
        matrix[i, j] = matrix[j, i] = r["correlation"] if r["correlation"] is not None else 0.0
    diagonal = np.diag(np.linalg.pinv(matrix))
    rows = [(c, float(diagonal[place[c]])) for c in columns]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")

"""Skew between training and serving, drift between successive windows, over shared bins."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

# Alert thresholds by feature.
DEFAULT_THRESHOLDS = {"delivery_delta": 0.3, "price": 0.2}
SMOOTHING = 1e-6
WINDOW_STATE = "window_start timestamp, window_end timestamp, feature string, bin int, n long, closed boolean, mark timestamp"


def bin_edges(df: DataFrame, columns: list[str], bins: int = 10) -> dict[str, tuple[float, float]]:
    """(low, width) of equal bins between the training extremes of each column."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"{c}_l") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_h") for c in columns],
    ).first()
    return {c: (row[f"{c}_l"], ((row[f"{c}_h"] - row[f"{c}_l"]) / bins) or 1.0) for c in columns}


def bin_of(column: str, low: float, width: float, bins: int) -> Column:
    """Bin number; values beyond the training range fall into the outer bins."""
    index = F.floor((F.col(column).cast("double") - F.lit(low)) / F.lit(width))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), index)).cast("int")


def binned(df: DataFrame, edges: Mapping[str, tuple[float, float]], bins: int, keys: list[Column | str] = ()) -> DataFrame:
    """Counts by (keys, feature, bin), the rows combined before they move."""
    features = list(edges)
    items = [
        F.struct(F.lit(c).alias("feature"), bin_of(c, *edges[c], bins).alias("bin")) for c in features
    ]
    long = df.select(*keys, F.inline(F.array(*items)))
    names = [k if isinstance(k, str) else long.columns[i] for i, k in enumerate(keys)]
    return long.where(F.col("bin").isNotNull()).groupBy(*names, "feature", "bin").agg(F.count("*").alias("n"))


def _shares(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy(*keys, "feature"))
    return counts.select(*keys, "feature", "bin", (F.col("n") / total).alias(name))


def divergence(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Jensen-Shannon (base 2), largest difference and stability index from shares p and q by bin."""
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    half = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    ps, qs = p + SMOOTHING, q + SMOOTHING
    return pairs.groupBy(*keys).agg(
        (F.sum(half(p) + half(q)) / 2).alias("js"),
        F.max(F.abs(p - q)).alias("l_inf"),
        F.sum((ps - qs) * F.log(ps / qs)).alias("psi"),
    )


def _alert(table: DataFrame, thresholds: Mapping[str, float], default: float) -> DataFrame:
    limit = F.lit(default)
    for feature, value in thresholds.items():
        limit = F.when(F.col("feature") == feature, value).otherwise(limit)
    return table.withColumn("threshold", limit).withColumn("alert", F.col("js") > F.col("threshold"))


def serving_skew(
    train: DataFrame,
    serving: DataFrame,
    columns: list[str],
    bins: int = 10,
    thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS,
    default: float = 0.3,
) -> DataFrame:
    """Per feature: distance between the training and the serving distribution, and the alert."""
    edges = bin_edges(train, columns, bins)
    p = _shares(binned(train, edges, bins), [], "p")
    q = _shares(binned(serving, edges, bins), [], "q")
    both = p.join(q, ["feature", "bin"], "full").na.fill(0.0, ["p", "q"])
    return _alert(divergence(both, ["feature"]), thresholds, default)


def window_drift(
    df: DataFrame,
    ts: str,
    columns: list[str],
    every: str = "1 hour",
    bins: int = 10,
    thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS,
    default: float = 0.3,
    edges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Per window and feature: distance to the window before it that has rows."""
    edges = edges or bin_edges(df, columns, bins)
    counts = binned(df, edges, bins, [F.window(ts, every)["start"].alias("window_start")])
    return successive_drift(counts, bins, thresholds, default)


def successive_drift(
    counts: DataFrame, bins: int = 10, thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS, default: float = 0.3
) -> DataFrame:
    """`window_drift` from counts by (window_start, feature, bin)."""
    shares = _shares(counts, ["window_start"], "q")
    # One row per (window, feature) with its whole histogram: the order is over windows, not events.
    hist = shares.groupBy("window_start", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "q"))).alias("h")
    )
    before = F.lag("h").over(Window.partitionBy("feature").orderBy("window_start"))
    steps = hist.withColumn("prev", before).where(F.col("prev").isNotNull())
    spread = steps.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    zero = F.lit(0.0)
    pairs = spread.select(
        "window_start",
        "feature",
        F.coalesce(F.try_element_at("prev", F.col("bin")), zero).alias("p"),
        F.coalesce(F.try_element_at("h", F.col("bin")), zero).alias("q"),
    )
    return _alert(divergence(pairs, ["window_start", "feature"]), thresholds, default)


def window_histograms(
    stream: DataFrame,
    ts: str,
    edges: Mapping[str, tuple[float, float]],
    every: str = "1 hour",
    late: str = "10 minutes",
    bins: int = 10,
) -> DataFrame:
    """Streaming counts by window, feature and bin; rows later than the watermark are not counted."""
    items = [F.struct(F.lit(c).alias("feature"), bin_of(c, *edges[c], bins).alias("bin")) for c in edges]
    long = stream.withWatermark(ts, late).select(ts, F.inline(F.array(*items))).where(F.col("bin").isNotNull())
    return long.groupBy(F.window(ts, every).alias("w"), "feature", "bin").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "feature", "bin", "n"
    )


def monitor_stream(
    stream: DataFrame,
    ts: str,
    train: DataFrame,
    columns: list[str],
    output_uri: str,
    checkpoint_uri: str,
    every: str = "1 hour",
    late: str = "10 minutes",
    bins: int = 10,
    thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS,
    default: float = 0.3,
) -> StreamingQuery:
    """Compare every finished window with the training histogram and write the result per batch.

    The baseline has bins x features rows. A batch is written under its own folder, so a repeated batch
    replaces itself.
    """
    edges = bin_edges(train, columns, bins)
    base = _shares(binned(train, edges, bins), [], "p").persist()

    def compare(batch: DataFrame, batch_id: int) -> None:
        q = _shares(batch, ["window_start"], "q")
        windows = q.select("window_start", "feature").distinct()
        grid = windows.join(base, "feature").join(q, ["window_start", "feature", "bin"], "full")
        table = _alert(divergence(grid.na.fill(0.0, ["p", "q"]), ["window_start", "feature"]), thresholds, default)
        table.write.mode("overwrite").parquet(f"{output_uri}/batch={batch_id}")

    return (
        window_histograms(stream, ts, edges, every, late, bins)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint_uri)
        .trigger(availableNow=True)
        .foreachBatch(compare)
        .start()
    )


@dataclass(frozen=True)
class WindowMonitor:
    """Drift between successive windows of a stream, with its state in tables.

    After batch i, `state/batch=i` holds the counts of every window that is still open, of the last window closed, and
    the watermark (latest event so far less `late`). It has a row for each window, feature and bin, whatever the events.
    Batch i reads the state of batch i - 1 and writes `drift/batch=i`, `late/batch=i` and its own state: a batch that is
    repeated after a failure replaces its output, and a stream that starts again goes on where it stopped.

    A window closes when the watermark reaches its end, and is compared with the one closed before it that has rows of the
    feature. Events of closed windows go to `late` with all their columns, so events on time and late ones are all events.
    Events without a time belong to no window and count as late. `finish` closes what is open when a stream has ended.
    """

    edges: Mapping[str, tuple[float, float]]
    ts: str
    output_uri: str
    every: str = "1 hour"
    late: str = "10 minutes"
    bins: int = 10
    thresholds: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    default: float = 0.3

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], WINDOW_STATE)
        return spark.read.schema(WINDOW_STATE).parquet(f"{self.output_uri}/state/batch={batch_id}")

    def _close(self, counts: DataFrame, mark: Column, batch: str) -> DataFrame:
        """Write the drift of the windows that end by `mark`; the counts with the state of their window.

        `counts` has one row for each window, feature and bin; `closed` marks the window that later ones are compared with.
        """
        ended = F.col("closed") | (F.col("window_end") <= mark)
        drifted = successive_drift(counts.where(ended), self.bins, self.thresholds, self.default)
        drifted.write.mode("overwrite").parquet(f"{self.output_uri}/drift/{batch}")
        latest = F.max(F.when(ended, F.col("window_start"))).over(Window.partitionBy("feature"))
        kept = counts.withColumn("_latest", latest).where(~ended | (F.col("window_start") == F.col("_latest")))
        return kept.withColumn("closed", ended).drop("_latest")

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """Add one batch of events."""
        spark = rows.sparkSession
        rows = rows.persist()
        before = self._state(spark, batch_id - 1).persist()
        reached = before.agg(F.max("mark")).first()[0]
        seen = F.col(self.ts).cast("timestamp")
        latest = rows.agg(F.max(seen - F.expr(f"interval {self.late}"))).first()[0]
        window = F.window(seen, self.every)
        timed = rows.where(seen.isNotNull())  # Spark's windows drop rows without a time
        closed = F.lit(False) if reached is None else window["end"] <= F.lit(reached)
        rows.where(seen.isNull()).unionByName(timed.where(closed).select(*rows.columns)).write.mode("overwrite").parquet(f"{self.output_uri}/late/batch={batch_id}")
        new = binned(timed.where(~closed), self.edges, self.bins, [window["start"].alias("window_start"), window["end"].alias("window_end")])
        held = before.where("feature is not null")
        keys = ["window_start", "window_end", "feature", "bin"]
        both = held.select(*keys, "n", "closed").unionByName(new.withColumn("closed", F.lit(False)))
        counts = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("closed").alias("closed")).persist()
        mark = max((m for m in (reached, latest) if m is not None), default=None)
        state = self._close(counts, F.lit(mark).cast("timestamp"), f"batch={batch_id}")
        marks = spark.createDataFrame([(mark,)], "mark timestamp")
        state.unionByName(marks, allowMissingColumns=True).select(*held.columns).coalesce(1).write.mode("overwrite").parquet(
            f"{self.output_uri}/state/batch={batch_id}"
        )
        for frame in (rows, before, counts):
            frame.unpersist()

    def start(self, stream: DataFrame, checkpoint_uri: str) -> StreamingQuery:
        """Work off what has arrived, batch by batch."""
        return (
            stream.writeStream.option("checkpointLocation", checkpoint_uri)
            .trigger(availableNow=True)
            .foreachBatch(self.batch)
            .start()
        )

    def finish(self, spark: SparkSession, last_batch: int) -> None:
        """Close all windows that are open after the last batch."""
        held = self._state(spark, last_batch).where("feature is not null").drop("mark")
        self._close(held, F.lit("9999-12-31").cast("timestamp"), "batch=end")

    def drift(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.output_uri}/drift").drop("batch")

    def late_events(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.output_uri}/late").drop("batch")

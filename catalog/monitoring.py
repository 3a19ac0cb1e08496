"""Skew, drift, sampled logs, streaming."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog.base import query, rounded
from shopsight.functions.text import add_text_features
from shopsight.learn.models import decision_tree
from shopsight.operators.encode import fit_preprocessor
from shopsight.session import scratch_uri
from shopsight.sources import bindings
from shopsight.streaming.drift import WindowMonitor, bin_edges, monitor_stream, serving_skew, window_drift
from shopsight.streaming.scoring import sampled_log, score_stream

_LIMITS = {"price": 0.2, "delivery_delta": 0.3}
_MEASURE = """(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)"""


def _serving(spark, sf):
    """Early and late orders; the later ones cost more."""
    orders = bindings.table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp")
    shaped = orders.select(
        late.alias("late"),
        F.when(late, F.col("o_totalprice") * 1.5).otherwise(F.col("o_totalprice")).alias("price"),
        (F.col("o_orderkey") * 7 % 40).cast("double").alias("delivery_delta"),
    )
    return shaped.where("NOT late").drop("late"), shaped.where("late").drop("late")


@query(
    "s1_serving_skew",
    """WITH s AS (SELECT o_orderdate >= TIMESTAMP '1999-01-01' AS late,
      CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice * 1.5::DOUBLE ELSE o_totalprice END AS price,
      CAST((o_orderkey * 7) % 40 AS DOUBLE) AS delivery_delta FROM orders),
    long AS (SELECT late, 'price' AS feature, price AS v FROM s UNION ALL SELECT late, 'delivery_delta', delivery_delta FROM s),
    edge AS (SELECT feature, min(v) AS lo, (max(v) - min(v)) / 10 AS w FROM long WHERE NOT late GROUP BY feature),
    b AS (SELECT late, feature, greatest(0, least(9, floor((v - lo) / w))) AS bin, count(*) AS n FROM long JOIN edge USING (feature) GROUP BY ALL),
    sh AS (SELECT *, n / sum(n) OVER (PARTITION BY late, feature) AS share FROM b),
    pq AS (SELECT feature, bin, coalesce(max(CASE WHEN NOT late THEN share END), 0.0) AS p, coalesce(max(CASE WHEN late THEN share END), 0.0) AS q
      FROM sh GROUP BY feature, bin)
    SELECT feature, round("""
    + _MEASURE
    + """, 4) AS js, round(max(abs(p - q)), 4) AS l_inf, round(sum((p - q) * ln((p + 0.000001::DOUBLE) / (q + 0.000001::DOUBLE))), 4) AS psi,
      CAST(CASE feature WHEN 'price' THEN 0.2 ELSE 0.3 END AS DOUBLE) AS threshold,
      """
    + _MEASURE
    + """ > CASE feature WHEN 'price' THEN 0.2 ELSE 0.3 END AS alert FROM pq GROUP BY feature""",
)
def skew(spark, sf):
    train, serving = _serving(spark, sf)
    return rounded(serving_skew(train, serving, ["price", "delivery_delta"], thresholds=_LIMITS))


_WINDOW_DRIFT = (
    """WITH edge AS (SELECT min(value) AS lo, (max(value) - min(value)) / 10 AS w FROM events),
    b AS (SELECT date_trunc('hour', ts) AS h, greatest(0, least(9, floor((value - lo) / w))) AS bin, count(*) AS n FROM events, edge GROUP BY ALL),
    sh AS (SELECT h, bin, n / sum(n) OVER (PARTITION BY h) AS share FROM b),
    hours AS (SELECT h, lag(h) OVER (ORDER BY h) AS before FROM (SELECT DISTINCT h FROM b)),
    grid AS (SELECT h, before, unnest(range(10)) AS bin FROM hours WHERE before IS NOT NULL),
    pq AS (SELECT grid.h, coalesce(x.share, 0.0) AS p, coalesce(y.share, 0.0) AS q FROM grid
      LEFT JOIN sh x ON x.h = grid.before AND x.bin = grid.bin LEFT JOIN sh y ON y.h = grid.h AND y.bin = grid.bin)
    SELECT strftime(h, '%Y-%m-%d %H:%M') AS window_start, round("""
    + _MEASURE
    + ", 4) AS js FROM pq GROUP BY h"
)


@query("s2_window_drift", _WINDOW_DRIFT)
def drift(spark, sf):
    table = window_drift(bindings.table(spark, sf, "events"), "ts", ["value"])
    return rounded(table.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "js"))


@query(
    "s3_sampled_log",
    """SELECT event_id, event_type FROM events
    WHERE CAST(concat('0x', substr(md5(event_id || ':42'), 1, 8)) AS BIGINT) % 1000000 < 100000""",
)
def log(spark, sf):
    return sampled_log(bindings.table(spark, sf, "events"), "event_id", 0.1).select("event_id", "event_type")


def _stream(spark, sf, name):
    """The files of one table, arriving as a stream, be it one file or a folder of them."""
    static = spark.read.parquet(f"{sf}/{name}.parquet")
    raw = spark.readStream.schema(static.schema).parquet(f"{sf}/{name}[.]parquet")  # a stream takes one file by a pattern only
    ntz = [f.name for f in static.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return raw.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else raw


@query("s2_successive_stream", _WINDOW_DRIFT)
def successive_stream(spark, sf):
    """Each hour of the event stream against the hour before it, the last one closed at the end."""
    uri = scratch_uri(spark, "windows")
    edges = bin_edges(bindings.table(spark, sf, "events"), ["value"])
    monitor = WindowMonitor(edges, "ts", uri, late="1 day")
    running = monitor.start(_stream(spark, sf, "events"), f"{uri}/checkpoint")
    running.awaitTermination()
    monitor.finish(spark, running.lastProgress["batchId"])
    found = monitor.drift(spark)
    return rounded(found.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "js"))


@query("s2_drift_stream")
def drift_stream(spark, sf):
    """Hourly windows of the event stream against the histogram of all events."""
    uri = scratch_uri(spark, "drift")
    running = monitor_stream(
        _stream(spark, sf, "events"), "ts", bindings.table(spark, sf, "events"), ["value"], f"{uri}/out", f"{uri}/state"
    )
    running.awaitTermination()
    found = spark.read.parquet(f"{uri}/out")
    return rounded(found.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "feature", "js", "alert"))


@query("s4_stream_scoring")
def scoring(spark, sf):
    """A stored pipeline applied to documents as they arrive."""
    def shaped(df):
        return add_text_features(df, "text").drop("text")

    labels = bindings.table(spark, sf, "labels").withColumn("label", F.col("quality").cast("double"))
    train = shaped(bindings.table(spark, sf, "documents")).join(labels, "doc_id").persist()
    prep = fit_preprocessor(train, ["n_chars", "review_word_count"], ["lang"])
    model = PipelineModel(stages=[*prep.stages, decision_tree(None, 4).fit(prep.transform(train))])
    uri = scratch_uri(spark, "scored")
    score_stream(shaped(_stream(spark, sf, "documents")), model, "doc_id", f"{uri}/out", f"{uri}/state").awaitTermination()
    return rounded(spark.read.parquet(f"{uri}/out"))

"""Streams against the same work in one batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from catalog.monitoring import _stream
from shopsight.streaming.drift import WindowMonitor, bin_edges, window_drift

SCHEMA = "event_id long, ts timestamp, price double, other double, n long"
START = datetime(2024, 1, 1)


def events(n=600, skip=()):
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=3 * i)
        if at.hour not in skip:
            rows.append((i, at, float((i * 7) % (20 + at.hour)), None if at.hour == 3 else float(i % 5), i))
    return rows


def arrive(spark, rows, uri, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{uri}/{name}")


def stream_of(spark, uri):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(uri)


def as_set(df):
    return {(r.window_start, r.feature, round(r.js, 9), round(r.l_inf, 9), round(r.psi, 9), r.alert) for r in df.collect()}


def test_successive_windows_survive_a_restart_and_equal_one_batch(spark, tmp_path):
    rows = events(skip=(7, 8))
    every = spark.createDataFrame(rows, SCHEMA)
    edges = bin_edges(every, ["price", "other"])
    monitor = WindowMonitor(edges, "ts", f"{tmp_path}/out", late="30 minutes")
    parts = [rows[i::1][k : k + 90] for i in (0,) for k in range(0, len(rows), 90)]
    for k, part in enumerate(parts):
        arrive(spark, part, f"{tmp_path}/in", f"p{k}")
        if k in (2, len(parts) - 1):  # the stream stops after three files and starts again
            running = monitor.start(stream_of(spark, f"{tmp_path}/in"), f"{tmp_path}/check")
            running.awaitTermination()
    assert monitor.drift(spark).count() < as_set(window_drift(every, "ts", ["price", "other"], edges=edges)).__len__()
    monitor.finish(spark, len(parts) - 1)
    assert as_set(monitor.drift(spark)) == as_set(window_drift(every, "ts", ["price", "other"], edges=edges))
    assert monitor.late_events(spark).count() == 0


def test_late_events_have_a_table_of_their_own(spark, tmp_path):
    rows = events(200)
    stale = [(9000 + i, START + timedelta(minutes=i), 1.0, 1.0, 0) for i in range(20)] + [(9999, None, 1.0, 1.0, 0)]
    edges = bin_edges(spark.createDataFrame(rows, SCHEMA), ["price"])
    monitor = WindowMonitor(edges, "ts", f"{tmp_path}/out")
    for k, part in enumerate((rows[:100], rows[100:], stale)):
        arrive(spark, part, f"{tmp_path}/in", f"p{k}")
        monitor.start(stream_of(spark, f"{tmp_path}/in"), f"{tmp_path}/check").awaitTermination()
    monitor.finish(spark, 2)
    late = monitor.late_events(spark)
    assert sorted(r.event_id for r in late.collect()) == [r[0] for r in stale] and "n" in late.columns
    assert as_set(monitor.drift(spark)) == as_set(window_drift(spark.createDataFrame(rows, SCHEMA), "ts", ["price"], edges=edges))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = events(100)
    monitor = WindowMonitor(bin_edges(spark.createDataFrame(rows, SCHEMA), ["price"]), "ts", f"{tmp_path}/out")
    for batch_id, part in ((0, rows[:50]), (1, rows[50:]), (1, rows[50:])):
        monitor.batch(spark.createDataFrame(part, SCHEMA), batch_id)
    monitor.finish(spark, 1)
    expected = window_drift(spark.createDataFrame(rows, SCHEMA), "ts", ["price"], edges=monitor.edges)
    assert as_set(monitor.drift(spark)) == as_set(expected)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_a_batch_without_events_keeps_the_state(spark, tmp_path, rows):
    monitor = WindowMonitor({"price": (0.0, 1.0)}, "ts", f"{tmp_path}/out")
    monitor.batch(spark.createDataFrame(events(30), SCHEMA), 0)
    before = monitor._state(spark, 0).collect()
    monitor.batch(spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted(map(repr, monitor._state(spark, 1).collect())) == sorted(map(repr, before))
    assert monitor.late_events(spark).count() == len(rows)


@pytest.mark.parametrize("folder", [False, True])
def test_a_table_streams_as_one_file_or_as_a_folder(spark, tmp_path, folder):
    arrive(spark, events(40), tmp_path, "made")
    if folder:
        arrive(spark, events(40), tmp_path, "events.parquet")
    else:
        (tmp_path / "events.parquet").write_bytes(next((tmp_path / "made").glob("part-*.parquet")).read_bytes())
    found = _stream(spark, tmp_path, "events")
    found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").count() == 40

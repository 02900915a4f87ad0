"""Streams replayed over files, compared with the batch operators."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.models import stream_highs
from tickloom.operators.windows import vwap_windows
from tickloom.session import scratch_path
from tickloom.sources.inputs import event_tick_stream, event_ticks
from tickloom.sources.lake import lake_scan, lake_stream
from tickloom.sources.ticks import alert_messages, decode_ticks, split_ticks
from tickloom.streaming.drawdown import stream_drawdown
from tickloom.streaming.sinks import file_writer, lake_writer, replay, start
from tickloom.streaming.windows import stream_windows

TICKS = "symbol string, price double, size double, ts timestamp"
T0 = datetime(2026, 5, 10, 5, 10)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def append_file(spark, path, rows, schema=TICKS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)  # file streams take files in order of their modification time


def file_stream(spark, path, schema=TICKS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def tick_files(spark):
    """Ticks of two symbols over two days, in six files of several windows each."""
    path = scratch_path(spark, "ticks")
    rows = [
        (s, 100.0 + (i * 37 % 23) * (1 if s == "A" else 0.1), 1.0 + i % 4, T0 + timedelta(minutes=11 * i))
        for i in range(240)
        for s in ("A", "B")
    ]
    for part in range(6):
        append_file(spark, path, rows[part * 80 : (part + 1) * 80])
    return path


def closed(windows, ticks):
    limit = ticks.agg(F.max("ts")).first()[0] - timedelta(minutes=10)
    return windows.filter(F.col("window_end") <= F.lit(limit))


def test_stream_equals_batch(spark, tick_files):
    batch = spark.read.schema(TICKS).parquet(tick_files)
    got = replay(stream_windows(file_stream(spark, tick_files)).drop("closed_at"), "windows")
    assert same(got, closed(vwap_windows(batch), batch))


def test_session_high_survives_batches(spark, tick_files):
    batch = spark.read.schema(TICKS).parquet(tick_files)
    got = replay(stream_drawdown(stream_windows(file_stream(spark, tick_files))), "alerts")
    want = stream_highs(vwap_windows(batch))
    assert same(got, closed(want, batch))
    assert 0 < got.filter("alert_type is not null").count() < got.count()


def test_events_stream_equals_batch(spark, folder):
    got = replay(stream_windows(event_tick_stream(spark, folder)).drop("closed_at"), "windows")
    batch = event_ticks(spark, folder)
    assert same(got, closed(vwap_windows(batch), batch))


def test_late_ticks_are_dropped_and_counted(spark):
    path = scratch_path(spark, "ticks")
    append_file(spark, path, [("A", 1.0, 1.0, T0)])
    append_file(spark, path, [("A", 1.0, 1.0, T0 + timedelta(hours=1))])
    # A batch drops what was late when the batch before it began.
    append_file(spark, path, [("A", 1.0, 1.0, T0 + timedelta(hours=1))])
    append_file(spark, path, [("A", 99.0, 1.0, T0), ("A", 3.0, 1.0, T0 + timedelta(minutes=52))])
    append_file(spark, path, [("A", 1.0, 1.0, T0 + timedelta(hours=2))])
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    windows = stream_windows(file_stream(spark, path)).drop("closed_at")
    query = start(file_writer(windows, out, checkpoint), once=True)
    assert query.awaitTermination(300)
    late = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert late == 1
    rows = {r.window_start: r for r in spark.read.parquet(out).collect()}
    assert rows[T0].max_price == 1.0  # the late price is in no window
    assert rows[T0 + timedelta(minutes=50)].vwap == 3.0  # within the delay: counted


def test_lake_sink_appends_once_across_restarts(spark):
    path, lake, checkpoint = (scratch_path(spark, n) for n in ("ticks", "lake", "checkpoint"))
    late_evening = datetime(2026, 5, 10, 23, 50)
    first = [("A", 1.0, 1.0, late_evening + timedelta(minutes=5 * i)) for i in range(6)]
    second = [("A", 2.0, 1.0, late_evening + timedelta(minutes=5 * i)) for i in range(6, 12)]

    def run():
        writer = lake_writer(stream_windows(file_stream(spark, path)), lake, checkpoint)
        assert start(writer, once=True).awaitTermination(300)

    append_file(spark, path, first)
    run()
    before = lake_scan(spark, lake).count()
    run()  # nothing new
    assert lake_scan(spark, lake).count() == before == 3
    append_file(spark, path, second)
    run()
    rows = lake_scan(spark, lake).orderBy("window_start").collect()
    assert [r.window_start for r in rows] == [late_evening + timedelta(minutes=5 * i) for i in range(9)]
    assert {str(r.date) for r in rows} == {"2026-05-10", "2026-05-11"}


def test_alerts_can_follow_the_lake(spark, tick_files):
    lake, checkpoint = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    writer = lake_writer(stream_windows(file_stream(spark, tick_files)), lake, checkpoint)
    assert start(writer, once=True).awaitTermination(300)
    got = replay(stream_drawdown(lake_stream(spark, lake)), "alerts")
    assert same(got, stream_highs(lake_scan(spark, lake).drop("date")))


def test_quarantine_and_windows_from_messages(spark):
    path = scratch_path(spark, "messages")

    def tick(minute, **changes):
        body = {"symbol": "A", "price": 10, "size": 2, "timestamp": (T0 + timedelta(minutes=minute)).isoformat() + "+00:00"}
        return (json.dumps({**body, **changes}),)

    append_file(
        spark, path, [tick(0), ("not json",), tick(1, price="12"), tick(2, price="x"), tick(60)], "value string"
    )
    good, bad = split_ticks(decode_ticks(file_stream(spark, path, "value string")))
    windows = replay(stream_windows(good).drop("closed_at"), "windows").collect()
    assert [(w.vwap, w.trade_count) for w in windows] == [(11.0, 2)]
    rejected = replay(bad, "quarantine").collect()
    assert sorted(r.reject_reason for r in rejected) == ["bad price", "not json"]


def test_alert_messages_from_a_stream(spark, tick_files):
    marked = stream_drawdown(stream_windows(file_stream(spark, tick_files)))
    sent = replay(alert_messages(marked), "messages").collect()
    bodies = [json.loads(r.value) for r in sent]
    assert {r.key for r in sent} == {"A", "B"}
    assert {"alert_type" in b for b in bodies} == {True, False}
    assert all(b["drawdown_pct"] > 3 for b in bodies if "alert_type" in b)

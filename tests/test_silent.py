"""Windows of symbols that fall silent."""

import time
from datetime import timedelta

from pyspark.sql import functions as F

from tickloom.operators.windows import vwap_windows
from tickloom.session import scratch_path
from tickloom.sources.inputs import event_tick_stream, event_ticks
from tickloom.streaming.silent import replay_until_silent, stream_silent_windows
from tickloom.streaming.sinks import file_writer
from test_streaming import T0, TICKS, append_file, file_stream, same


def test_all_windows_come_out(spark, folder):
    stream = stream_silent_windows(event_tick_stream(spark, folder), idle="3 seconds")
    got = replay_until_silent(stream, "silent", "3 seconds")
    assert same(got, vwap_windows(event_ticks(spark, folder)))


def test_ticks_spread_over_batches_make_one_window_each(spark):
    path = scratch_path(spark, "ticks")
    rows = [(s, 100.0 + i * 37 % 23, 1.0 + i % 4, T0 + timedelta(minutes=i)) for i in range(60) for s in ("A", "B")]
    for part in range(5):
        append_file(spark, path, rows[part::5] if part == 9 else rows[part * 24 : (part + 1) * 24])
    append_file(spark, path, [("C", 5.0, 0.0, T0), (None, 1.0, 1.0, T0), ("C", None, 1.0, T0)])
    got = replay_until_silent(stream_silent_windows(file_stream(spark, path), idle="4 seconds"), "silent", "4 seconds")
    batch = spark.read.schema(TICKS).parquet(path).dropna()
    assert same(got, vwap_windows(batch))


def test_closed_windows_stay_closed_and_a_restart_goes_on(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("ticks", "out", "checkpoint"))

    def run(seconds):
        stream = stream_silent_windows(file_stream(spark, path), idle="2 seconds")
        query = file_writer(stream, out, checkpoint).trigger(processingTime="500 milliseconds").start()
        time.sleep(seconds)
        query.stop()
        return {(r.symbol, r.window_start, r.trade_count) for r in spark.read.parquet(out).collect()}

    later = T0 + timedelta(minutes=40)
    append_file(spark, path, [("A", 1.0, 1.0, T0), ("A", 2.0, 1.0, T0 + timedelta(minutes=20))])
    first = run(15)
    assert first == {("A", T0, 1), ("A", T0 + timedelta(minutes=20), 1)}
    # Too late for either window; the new one waits for its own silence.
    append_file(spark, path, [("A", 9.0, 1.0, T0), ("A", 9.0, 1.0, T0 + timedelta(minutes=21)), ("A", 3.0, 1.0, later)])
    assert run(15) == first | {("A", later, 1)}
    assert spark.read.parquet(out).agg(F.count("*")).first()[0] == 3

"""Live figures against the batch operators, over restarts and failures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.models import stream_highs
from tickloom.operators.positions import portfolio_value, position_pnl
from tickloom.schemas import POSITION
from tickloom.session import scratch_path
from tickloom.sources import versioned
from tickloom.sources.lake import lake_scan, lake_stream, write_lake
from tickloom.sources.positions import load_positions
from tickloom.streaming import live
from tickloom.streaming.drawdown import stream_drawdown
from tickloom.streaming.sinks import file_writer, start
from test_streaming import T0, TICKS, append_file, file_stream, same

TRADES = "event_type string, symbol string, shares bigint, price double, portfolio_id string, ts timestamp"


def paths(spark, *names):
    return [scratch_path(spark, n) for n in names]


def run(writer):
    assert start(writer, once=True).awaitTermination(300)


def held(spark, path, rows):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POSITION)
    names = [f.name for f in POSITION]
    full = [tuple(r.get(n) for n in names) for r in rows]
    spark.createDataFrame(full, columns).coalesce(1).write.mode("overwrite").parquet(path)


def trade(symbol, price, minute):
    return ("BUY", symbol, 2, price, "p", T0 + timedelta(minutes=minute))


def test_trades_meet_the_positions_of_their_batch(spark):
    trades, positions, out, checkpoint = paths(spark, "trades", "positions", "pnl", "checkpoint")
    held(spark, positions, [{"symbol": "A", "avg_cost": 10.0, "total_shares": 5}])
    append_file(spark, trades, [trade("A", 12.0, 0), trade("B", 3.0, 1)], TRADES)

    def writer():
        stream = file_stream(spark, trades, TRADES)
        return live.live_pnl_writer(stream, lambda: load_positions(spark, positions), out, checkpoint)

    run(writer())
    held(spark, positions, [{"symbol": "A", "avg_cost": 20.0, "total_shares": 7}])
    append_file(spark, trades, [trade("A", 12.0, 2)], TRADES)
    run(writer())
    schema = position_pnl(spark.read.schema(TRADES).parquet(trades), load_positions(spark, positions)).schema
    rows = live.published(spark, out, schema).orderBy("ts").collect()
    assert [(r.symbol, r.avg_cost, r.unrealized_pnl, r.batch_id) for r in rows] == [
        ("A", 10.0, 10.0, 0), ("B", None, None, 0), ("A", 20.0, -56.0, 1)
    ]


def test_a_batch_that_failed_goes_out_once(spark):
    source, out, checkpoint = paths(spark, "ticks", "sent", "checkpoint")
    for i in range(3):
        append_file(spark, source, [("A", float(i), 1.0, T0), ("B", float(i), 1.0, T0)])
    fails = {"left": 1}

    def writer():
        inner = live.publish_once(file_stream(spark, source), out, checkpoint)

        def write(batch, number):
            batch.write.mode("overwrite").parquet(f"{out}/{live.BATCH}={number}")
            if number == 1 and fails["left"]:
                fails["left"] -= 1
                raise RuntimeError("after the rows went out")

        return inner.foreachBatch(write) if fails["left"] else inner

    query = start(writer(), once=True)
    with pytest.raises(Exception, match="after the rows went out"):
        query.awaitTermination(300)
    run(writer())
    rows = live.published(spark, out, spark.read.schema(TICKS).parquet(source).schema)
    assert same(rows.drop(live.BATCH), spark.read.schema(TICKS).parquet(source))
    assert sorted({r.batch_id for r in rows.collect()}) == [0, 1, 2]


def test_live_value_equals_the_batch_value(spark):
    source, prices, checkpoint = paths(spark, "ticks", "prices", "checkpoint")
    for part in range(4):
        rows = [(s, 10.0 * part + i, 1.0, T0 + timedelta(minutes=7 * i - 20 * part)) for i in range(9) for s in ("A", "B", "C")[: part % 3 + 1]]
        append_file(spark, source, rows)
    positions = spark.createDataFrame([("A", 3, 1.0), ("B", 4, 1.0), ("Z", 5, 2.5)], "symbol string, total_shares bigint, avg_cost double")
    run(live.live_prices_writer(file_stream(spark, source), prices, checkpoint))
    batch = spark.read.schema(TICKS).parquet(source)
    assert same(live.live_portfolio_value(spark, prices, positions), portfolio_value(batch, positions))
    # A restart with more ticks goes on from there; a symbol without new ticks keeps its price.
    append_file(spark, source, [("B", 777.0, 1.0, T0 + timedelta(days=1)), ("A", 1.0, 1.0, T0 - timedelta(days=1))])
    run(live.live_prices_writer(file_stream(spark, source), prices, checkpoint))
    batch = spark.read.schema(TICKS).parquet(source)
    assert same(live.live_portfolio_value(spark, prices, positions), portfolio_value(batch, positions))


def test_upserts_repeat_without_effect_and_keep_the_latest(spark):
    target = scratch_path(spark, "table")
    kind = "symbol string, price double, ts timestamp"

    def put(*rows):
        live.upsert(spark.createDataFrame(list(rows), kind), target, "symbol", "ts")
        return {(r.symbol, r.price) for r in versioned.current(spark, target, live._LAST_PRICE).collect()}

    assert put(("A", 1.0, T0), ("B", 2.0, T0)) == {("A", 1.0), ("B", 2.0)}
    late = ("A", 9.0, T0 - timedelta(hours=1))
    assert put(late) == put(late) == {("A", 1.0), ("B", 2.0)}
    assert put(("A", 5.0, T0 + timedelta(hours=1))) == {("A", 5.0), ("B", 2.0)}


def test_highs_survive_a_stop_and_are_read_from_the_state(spark):
    lake, out, checkpoint = paths(spark, "lake", "alerts", "checkpoint")
    start_of = datetime(2026, 5, 10)
    columns = "symbol string, window_start timestamp, window_end timestamp, vwap double, min_price double, max_price double, volatility double, price_range double, trade_count bigint, total_volume double"

    def half(day, vwaps):
        rows = [
            (s, start_of + timedelta(days=day, minutes=5 * i), start_of + timedelta(days=day, minutes=5 * i + 5), v * scale, 1.0, 2.0, 0.1, 1.0, 3, 4.0)
            for i, v in enumerate(vwaps) for s, scale in (("A", 1.0), ("B", 0.5))
        ]
        write_lake(spark.createDataFrame(rows, columns), f"{lake}/day{day}")
        return f"{lake}/day{day}"

    first = half(0, [10.0, 30.0, 20.0])
    run(file_writer(stream_drawdown(lake_stream(spark, first)), out, checkpoint))
    read = {r.symbol: r.vwap_high for r in live.stored_highs(spark, checkpoint).collect()}
    assert read == {"A": 30.0, "B": 15.0}
    # The second half comes into the folder that the stream reads, after a restart.
    rows = spark.read.parquet(half(1, [25.0, 40.0]))
    rows.write.mode("append").partitionBy("date").parquet(first)
    run(file_writer(stream_drawdown(lake_stream(spark, first)), out, checkpoint))
    whole = lake_scan(spark, first).groupBy("symbol").agg(F.max("vwap").alias("vwap_high"))
    assert same(live.stored_highs(spark, checkpoint), whole)
    got = spark.read.parquet(out).count()
    assert got == stream_highs(lake_scan(spark, first).drop("date")).count() == 10

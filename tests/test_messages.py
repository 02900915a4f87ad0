import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.functions.risk import iso_utc, utc_date
from tickloom.operators.models import stream_highs
from tickloom.operators.positions import portfolio_value, position_pnl
from tickloom.schemas import TICK as TICK_SCHEMA
from tickloom.sources.ticks import (
    alert_messages,
    decode_events,
    decode_ticks,
    encode_events,
    encode_ticks,
    normalize_ticks,
    rejected_trades,
    split_ticks,
)

TICK = {
    "symbol": "NVDA",
    "price": 820.1,
    "size": 10.5,
    "timestamp": "2026-05-10T05:10:00.250000+00:00",
    "source": "simulator",
    "exchange": "NYSE",
    "conditions": ["@", "T"],
}


def message(**changes):
    tick = {**TICK, **changes}
    return json.dumps({k: v for k, v in tick.items() if v is not ...})


def decode(spark, *texts):
    return decode_ticks(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_valid_tick(spark):
    row = decode(spark, message()).first()
    assert (row.symbol, row.price, row.size, row.exchange) == ("NVDA", 820.1, 10.5, "NYSE")
    assert row.ts == datetime(2026, 5, 10, 5, 10, 0, 250000)
    assert row.conditions == ["@", "T"]
    assert row.reject_reason is None and row.rejected_value is None


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (message(price="12.5"), None),
        (message(exchange=..., conditions=...), None),
        (message(timestamp="2026-05-10T07:10:00+02:00"), None),
        (message(size=...), "no size"),
        (message(symbol=...), "no symbol"),
        (message(price=None), "no price"),
        (message(price="abc"), "bad price"),
        (message(price="NaN"), "bad price"),
        (message(size="Infinity"), "bad size"),
        (message(timestamp="yesterday"), "bad timestamp"),
        (message(timestamp=...), "bad timestamp"),
        ("not json", "not json"),
        (message()[:-2], "not json"),
        ("", "no symbol"),
        ("{}", "no symbol"),
        (None, "no symbol"),
    ],
)
def test_reject_reasons(spark, text, reason):
    row = decode(spark, text).first()
    assert row.reject_reason == reason


def test_defaults_and_numeric_text(spark):
    row = decode(spark, message(price="12.5", exchange=..., conditions=...)).first()
    assert (row.price, row.exchange, row.conditions) == (12.5, "unknown", [])


def test_split_loses_nothing(spark):
    texts = [message(), "not json", message(price="x"), message(symbol="A")]
    good, bad = split_ticks(decode(spark, *texts))
    assert {r.symbol for r in good.collect()} == {"NVDA", "A"}
    assert {r.value for r in bad.collect()} == {"not json", message(price="x")}


def test_binary_values_decode(spark):
    raw = spark.createDataFrame([(bytearray(message().encode()),)], "value binary")
    assert decode_ticks(raw).first().symbol == "NVDA"


def test_parser_runs_once(spark):
    good, _ = split_ticks(decode(spark, message()))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_tick_round_trip(spark):
    good, _ = split_ticks(decode(spark, message()))
    encoded = encode_ticks(good).first()
    assert encoded.key == "NVDA"
    assert json.loads(encoded.value) == TICK


def test_normalize(spark):
    trades = spark.createDataFrame(
        [("A", "1.5", 2, "2026-05-10T07:10:00+02:00")], "symbol string, price string, size int, timestamp string"
    )
    normal = normalize_ticks(trades, "feed")
    assert [(f.name, f.dataType) for f in normal.schema] == [(f.name, f.dataType) for f in TICK_SCHEMA]
    row = normal.first()
    assert row.ts == datetime(2026, 5, 10, 5, 10)
    assert (row.price, row.size, row.source, row.exchange, row.conditions) == (1.5, 2.0, "feed", "unknown", [])


@pytest.fixture(scope="module")
def positions(spark):
    # Part of the demo portfolio.
    rows = [("AAPL", 500, 172.50), ("NVDA", 150, 820.00), ("SPY", 400, 510.00)]
    return spark.createDataFrame(rows, "symbol string, total_shares bigint, avg_cost double")


@pytest.fixture(scope="module")
def trades(spark):
    rows = [
        ("BUY", "AAPL", 10, 180.004, "P", datetime(2026, 5, 10, 5, 10)),
        ("SELL", "NVDA", 3, 795.0, "P", datetime(2026, 5, 10, 5, 11)),
        ("SELL", "NVDA", 3, 800.0, "P", datetime(2026, 5, 10, 5, 12)),
    ]
    return spark.createDataFrame(
        rows, "event_type string, symbol string, shares bigint, price double, portfolio_id string, ts timestamp"
    )


def test_position_pnl(trades, positions):
    rows = {(r.symbol, r.price): r for r in position_pnl(trades, positions).collect()}
    aapl = rows[("AAPL", 180.0)]
    assert (aapl.notional, aapl.unrealized_pnl, aapl.pnl_pct) == (1800.04, 3752.0, 4.35)
    nvda = rows[("NVDA", 795.0)]
    assert (nvda.notional, nvda.unrealized_pnl, nvda.pnl_pct) == (2385.0, -3750.0, -3.05)


def test_trade_without_a_position_is_kept(trades, positions):
    rows = position_pnl(trades, positions.filter("symbol = 'NVDA'")).filter("symbol = 'AAPL'").collect()
    assert [(r.notional, r.avg_cost, r.unrealized_pnl, r.pnl_pct) for r in rows] == [(1800.04, None, None, None)]


def test_event_round_trip(trades, positions):
    enriched = position_pnl(trades, positions)
    messages = encode_events(enriched)
    nested = json.loads(messages.filter("key = 'AAPL'").first().value)
    assert nested["metadata"] == {
        "avg_cost": 172.5, "total_shares": 500, "unrealized_pnl": 3752.0, "pnl_pct": 4.35,
    }
    decoded = decode_events(messages).drop("key").select(*enriched.columns)
    assert decoded.exceptAll(enriched).count() == 0 and enriched.exceptAll(decoded).count() == 0


def test_portfolio_value_uses_last_prices_and_cost_without_one(trades, positions):
    row = portfolio_value(trades, positions).first()
    assert row.positions == 3
    assert row.market_value == pytest.approx(500 * 180.004 + 150 * 800.0 + 400 * 510.0)


def test_every_window_is_sent_and_only_drawdowns_are_marked(spark, five_rows):
    falling = five_rows.filter("trade_count = 311")
    later = falling.selectExpr(
        "symbol", "window_start + interval 5 minutes as window_start",
        "window_end + interval 5 minutes as window_end", "vwap * 0.9 as vwap",
        *[c for c in five_rows.columns if c not in ("symbol", "window_start", "window_end", "vwap")],
    )
    sent = [
        json.loads(r.value) for r in alert_messages(stream_highs(falling.unionByName(later))).collect()
    ]
    first, second = sorted(sent, key=lambda m: m["window_start"])
    assert "alert_type" not in first and "session_high" not in first
    assert (second["alert_type"], second["session_high"], second["drawdown_pct"]) == ("DRAWDOWN", 195.0, 10.0)
    assert first["window_start"] == "2026-05-10T05:10:00+00:00"


def test_times_do_not_depend_on_the_session_zone(spark):
    instants = [
        datetime(2026, 5, 10, 2, 0, tzinfo=timezone.utc), datetime(2026, 3, 8, 7, 30, 0, 120, tzinfo=timezone.utc),
        datetime(2026, 11, 1, 6, 30, tzinfo=timezone.utc), datetime(1969, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc),
    ]
    micros = [int((t - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1)) for t in instants]
    found = []
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("ts"))
            found.append([tuple(r) for r in df.select(iso_utc(F.col("ts")), utc_date(F.col("ts")).cast("string")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1] == found[2] == [(t.isoformat(), str(t.date())) for t in instants]


def test_bad_trades_are_rejected_and_never_thrown(spark):
    rows = [("A", "1.5", "2", "2026-05-10T01:00:00Z"), ("A", "abc", "2", "2026-05-10T01:00:00Z"), (None, "1", "1", "2026-05-10T01:00:00Z"),
            ("A", "1", "NaN", "2026-05-10T01:00:00Z"), ("A", "1", "1", "yesterday")]
    trades = spark.createDataFrame(rows, "symbol string, price string, size string, timestamp string")
    assert normalize_ticks(trades, "feed").where("symbol is null or price is null or size is null or ts is null").count() == 4
    assert [r.reject_reason for r in rejected_trades(trades).collect()] == ["bad price", "no symbol", "bad size", "bad timestamp"]

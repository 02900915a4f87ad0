from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import LAKE_ROWS, as_dicts
from pyspark.sql import functions as F

from tickloom.operators import session_queries as asked
from tickloom.operators.models import (
    alerts_in_order,
    portfolio_summary,
    stg_windows,
    stream_highs,
    volatility_alerts,
    vwap_facts,
)
from tickloom.plans.marts import (
    build_mart_tables,
    build_marts,
    current_marts,
    read_marts,
    serve_portfolio,
)
from tickloom.schemas import FACT_CONTRACT, WINDOW, WINDOW_TEXT
from tickloom.session import scratch_path
from tickloom.sources.lake import lake_scan, write_lake

T0 = datetime(2026, 5, 10, 5, 10)


def windows(spark, rows):
    """(symbol, window number, vwap, max, volatility) rows as windows."""
    full = [
        (s, T0 + timedelta(minutes=5 * i), T0 + timedelta(minutes=5 * i + 5), float(v), float(v) - 1,
         float(h), vol, 1.0, 10, 100.0)
        for s, i, v, h, vol in rows
    ]
    return spark.createDataFrame(full, WINDOW)


def test_staging_keeps_one_fragment_per_window(five_rows):
    rows = as_dicts(stg_windows(five_rows), "symbol")
    assert {s: r["vwap"] for s, r in rows.items()} == {"AAPL": 172.50, "NVDA": 820.0, "TSLA": 195.0}


def test_staging_prefers_the_later_end(spark, five_rows):
    later = five_rows.filter("trade_count = 250").withColumn(
        "window_end", F.col("window_end") + F.expr("interval 1 second")
    )
    rows = as_dicts(stg_windows(five_rows.unionByName(later)), "symbol")
    assert rows["AAPL"]["vwap"] == 172.55


def test_staging_reads_text_timestamps_with_offsets(spark):
    row = ("A", "2026-05-10T07:10:00+02:00", "2026-05-10T05:15:00+00:00", 1.0, 1.0, 1.0, 0.0, 0.0, 1, 1.0)
    staged = stg_windows(spark.createDataFrame([row], WINDOW_TEXT)).first()
    assert staged.window_start == datetime(2026, 5, 10, 5, 10)
    assert staged.window_end == datetime(2026, 5, 10, 5, 15)


def test_facts_of_the_five_row_lake(five_rows):
    rows = as_dicts(vwap_facts(stg_windows(five_rows)), "symbol")
    got = {s: (r["session_high"], r["drawdown_pct"], r["volatility_rank"]) for s, r in rows.items()}
    assert got == {
        "NVDA": (820.11, 0.0134, 1),
        "TSLA": (195.08, 0.0410, 2),
        "AAPL": (172.53, 0.0174, 3),
    }


def test_alerts_of_the_five_row_lake(five_rows):
    rows = alerts_in_order(volatility_alerts(vwap_facts(stg_windows(five_rows)))).collect()
    assert [(r.symbol, r.drawdown_pct, r.alert_type) for r in rows] == [
        ("TSLA", 0.04, "WATCH"),
        ("AAPL", 0.02, "WATCH"),
        ("NVDA", 0.01, "HIGHEST_VOL"),
    ]


def test_session_high_is_the_running_one(spark):
    facts = vwap_facts(windows(spark, [("A", 0, 100, 110, 0.1), ("A", 1, 90, 95, 0.1), ("A", 2, 100, 200, 0.1)]))
    rows = facts.orderBy("window_start").collect()
    assert [r.session_high for r in rows] == [110.0, 110.0, 200.0]
    assert [r.drawdown_pct for r in rows] == [9.0909, 18.1818, 50.0]


def test_session_high_carries_over_days(spark):
    rows = [("A", 0, 100, 500, 0.1), ("A", 288, 100, 100, 0.1), ("A", 3 * 288, 100, 120, 0.1)]
    got = vwap_facts(windows(spark, rows)).orderBy("window_start").collect()
    assert [r.session_high for r in got] == [500.0, 500.0, 500.0]


def test_rank_leaves_gaps_and_puts_unknown_last(spark):
    rows = [("A", 0, 1, 1, 0.5), ("B", 0, 1, 1, 0.5), ("C", 0, 1, 1, 0.1), ("D", 0, 1, 1, None)]
    got = as_dicts(vwap_facts(windows(spark, rows)), "symbol")
    assert {s: r["volatility_rank"] for s, r in got.items()} == {"A": 1, "B": 1, "C": 3, "D": 4}


def test_alert_threshold_is_strict_and_on_the_rounded_percent(spark):
    rows = [(s, 0, 100, 100, 9.0) for s in ("R1", "R2", "R3")]  # take ranks 1 to 3
    rows += [("EXACT", 0, 97, 100, 0.0), ("ABOVE", 0, 96.99, 100, 0.0), ("ZERO", 0, 0, 0, 0.0)]
    got = as_dicts(volatility_alerts(vwap_facts(windows(spark, rows))), "symbol")
    assert set(got) == {"R1", "R2", "R3", "ABOVE"}
    assert got["ABOVE"]["alert_type"] == "DRAWDOWN"
    assert got["R1"]["alert_type"] == "HIGHEST_VOL"


def test_summary_and_regimes(spark):
    rows = [("H", 0, 1, 1, 0.0501), ("M", 0, 1, 1, 0.05), ("L", 0, 1, 1, 0.015), ("N", 0, 1, 1, None)]
    got = as_dicts(portfolio_summary(vwap_facts(windows(spark, rows))), "symbol")
    assert {s: r["volatility_regime"] for s, r in got.items()} == {
        "H": "HIGH", "M": "MEDIUM", "L": "LOW", "N": "LOW",
    }


def test_regime_uses_the_rounded_average(spark):
    rows = [("A", 0, 1, 1, 0.0500004)]
    assert portfolio_summary(vwap_facts(windows(spark, rows))).first().volatility_regime == "MEDIUM"


def test_session_summary_of_the_five_row_lake(five_rows):
    rows = asked.session_summary(five_rows).orderBy(F.desc("avg_volatility")).collect()
    got = [
        (r.symbol, r.windows, r.session_low, r.session_high, r.avg_volatility, r.session_range_pct, r.total_trades)
        for r in rows
    ]
    assert got == [
        ("NVDA", 2, 819.78, 820.11, 0.04285, 0.0004, 586),
        ("TSLA", 1, 194.94, 195.08, 0.0135, 0.0007, 311),
        ("AAPL", 2, 172.47, 172.60, 0.0085, 0.0008, 537),
    ]


def test_drawdown_against_the_whole_session(five_rows):
    rows = as_dicts(asked.drawdown_vs_session(five_rows, threshold=None), "symbol")
    assert {s: r["drawdown_pct"] for s, r in rows.items()} == {"AAPL": 0.06, "NVDA": 0.01, "TSLA": 0.04}
    assert asked.drawdown_vs_session(five_rows).count() == 0


def test_drawdown_sees_later_and_earlier_windows(spark):
    w = windows(spark, [("A", 0, 100, 100, 0.1), ("A", 1, 96, 97, 0.1), ("Z", 0, 0, 0, 0.0)])
    row = asked.drawdown_vs_session(w).first()
    assert (row.symbol, row.current_vwap, row.session_high, row.drawdown_pct) == ("A", 96.0, 100.0, 4.0)


def test_other_lake_queries(five_rows):
    assert asked.full_scan_count(five_rows).first().row_count == 5
    assert {r.symbol: r.windows for r in asked.windows_per_symbol(five_rows).collect()} == {
        "AAPL": 2, "NVDA": 2, "TSLA": 1,
    }
    assert asked.latest_window(five_rows).count() == 3
    assert [r.symbol for r in asked.volatility_trend(five_rows).orderBy("symbol", "window_start").collect()] == [
        "AAPL", "AAPL", "NVDA", "NVDA", "TSLA",
    ]


def test_symbol_filter_reaches_the_scan(spark, five_rows):
    path = scratch_path(spark, "lake")
    write_lake(five_rows, path)
    plan = asked.symbol_filter(lake_scan(spark, path), "AAPL")
    assert plan.count() == 2
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,AAPL)" in text


def test_three_highs_differ(spark):
    """Running max of VWAP, running max of the window high, and whole-session high."""
    w = windows(spark, [("A", 0, 100, 101, 0.1), ("A", 1, 90, 91, 0.1), ("A", 2, 99, 150, 0.1)])
    second = 1
    streamed = stream_highs(w).orderBy("window_start").collect()[second]
    fact = vwap_facts(w).orderBy("window_start").collect()[second]
    session = asked.drawdown_vs_session(w).first()
    assert (streamed.session_high, streamed.drawdown_pct) == (100.0, 10.0)
    assert (fact.session_high, fact.drawdown_pct) == (101.0, 10.8911)
    assert (session.session_high, session.drawdown_pct) == (150.0, 34.0)


def test_stream_check_uses_the_unrounded_ratio(spark):
    w = windows(spark, [("A", 0, 100, 1, 0.1), ("A", 1, 97, 1, 0.1), ("A", 2, 96.9999, 1, 0.1)])
    assert [r.alert_type for r in stream_highs(w).orderBy("window_start").collect()] == [None, None, "DRAWDOWN"]


@pytest.fixture(scope="module")
def marts(spark, five_rows):
    path = scratch_path(spark, "lake")
    write_lake(five_rows, path)
    return build_marts(lake_scan(spark, path), scratch_path(spark, "marts"))


def test_marts_are_stored_under_their_contracts(marts):
    assert marts.facts.schema.fieldNames() == FACT_CONTRACT.schema.fieldNames()
    assert (marts.facts.count(), marts.summary.count(), marts.alerts.count()) == (3, 3, 3)


def test_marts_can_be_rebuilt_from_their_own_lake(spark, five_rows):
    root = scratch_path(spark, "marts")
    build_marts(five_rows, root)
    build_marts(five_rows.filter("symbol = 'TSLA'"), root)
    assert [r.symbol for r in current_marts(spark, root).summary.collect()] == ["TSLA"]


def test_mart_tables(spark, five_rows):
    build_mart_tables(five_rows, "marts_test")
    build_mart_tables(five_rows, "marts_test")  # a rebuild replaces
    again = read_marts(spark, "marts_test")
    assert (again.facts.count(), again.summary.count(), again.alerts.count()) == (3, 3, 3)


def test_serving_records(spark, marts):
    rows = serve_portfolio(marts.summary, marts.alerts).collect()
    assert sorted({r.section for r in rows}) == ["alerts", "portfolio"]
    nvda = next(r.record for r in rows if r.section == "alerts" and r.symbol == "NVDA")
    assert '"alert_type":"HIGHEST_VOL"' in nvda


def test_lake_prunes_days_and_keeps_the_partition_date(spark, five_rows):
    path = scratch_path(spark, "lake")
    write_lake(five_rows, path)
    write_lake(five_rows.withColumn("window_start", F.col("window_start") + F.expr("interval 1 day")), path)
    assert lake_scan(spark, path).count() == 10
    one_day = lake_scan(spark, path, first_day="2026-05-11", last_day="2026-05-11")
    assert one_day.count() == 5
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_lake_written_elsewhere(spark, tmp_path):
    """Text bounds, and ``date`` both in the files and in the folder name."""
    day = tmp_path / "risk" / "date=2026-05-10"
    day.mkdir(parents=True)
    names = [c for c in WINDOW_TEXT.fieldNames() if not c.startswith("window")]
    rows = pd.DataFrame(LAKE_ROWS, columns=names)
    rows.insert(1, "window_start", "2026-05-10T05:10:00+00:00")
    rows.insert(2, "window_end", "2026-05-10T05:15:00+00:00")
    rows.assign(date="2026-05-10").to_parquet(day / "data.parquet")
    lake = lake_scan(spark, str(tmp_path / "risk"), schema=WINDOW_TEXT)
    assert lake.count() == 5
    staged = stg_windows(lake)
    assert staged.schema.fieldNames() == WINDOW.fieldNames()
    assert {(r.symbol, r.window_start) for r in staged.collect()} == {(s, T0) for s in ("AAPL", "NVDA", "TSLA")}
    assert asked.session_summary(lake).count() == 3

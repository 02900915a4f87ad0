"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the input folder, ``BENCH_CPUS`` the number of local cores. Builds (windows
from ticks, lake, marts) are timed once or a few times; queries on stored data are run warm, on
one session, and reported as the median, the way the published latencies were taken.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tickloom.operators import dashboard, models, positions, retrieval
from tickloom.operators import session_queries as asked
from tickloom.operators.windows import vwap_windows
from tickloom.plans.marts import build_marts
from tickloom.plans.workspace import Workspace
from tickloom.session import build_session, scratch_path
from tickloom.sources import inputs, mirror
from tickloom.sources.lake import lake_scan, write_lake
from tickloom.streaming.sinks import replay
from tickloom.streaming.windows import stream_windows

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS, WARM_RUNS, WARMUP = 3, 30, 10


def median_seconds(action: Callable[[], object], runs: int, warmup: int) -> float:
    for _ in range(warmup):
        action()
    times = []
    for _ in range(runs):
        begun = time.perf_counter()
        action()
        times.append(time.perf_counter() - begun)
    return round(statistics.median(times), 4)


def to_nowhere(df: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = Workspace(spark, FOLDER)
    seconds: dict[str, float] = {}

    def timed(name: str, action: Callable[[], object], runs: int, warmup: int) -> None:
        seconds[name] = median_seconds(action, runs, warmup)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)

    # Whole-table work: ticks, trades, vectors.
    events, lines = inputs.event_ticks(spark, FOLDER), inputs.lineitem_ticks(spark, FOLDER)
    parts, trades = inputs.part_positions(spark, FOLDER), inputs.lineitem_trades(spark, FOLDER)
    vectors = inputs.table(spark, FOLDER, "embeddings")
    centers = retrieval.centroids(vectors, "label").withColumnRenamed("label", "query_id")
    docs = vectors.withColumnRenamed("vec_id", "doc_id")
    for name, df in {
        "vwap_windows_events": vwap_windows(events),
        "vwap_windows_lineitem": vwap_windows(lines, "1 day"),
        "value_percentiles": dashboard.value_percentiles(events, "symbol", "price"),
        "position_pnl": positions.position_pnl(trades, parts),
        "portfolio_value": positions.portfolio_value(trades, parts),
    }.items():
        timed(name, lambda df=df: to_nowhere(df), RUNS, 1)
    timed("topk_cosine", lambda: to_nowhere(retrieval.topk_cosine(centers, docs)), RUNS, 1)

    # Builds.
    timed(
        "lake_build", lambda: write_lake(vwap_windows(events), scratch_path(spark, "lake")), 1, 0
    )
    lake = lake_scan(spark, work.lake_path())
    timed("marts_build", lambda: build_marts(lake, scratch_path(spark, "marts")), RUNS, 1)
    copy = scratch_path(spark, "mirror")
    timed("mirror_refresh", lambda: mirror.mirror_refresh(lake, copy), RUNS, 1)
    stream = stream_windows(inputs.event_tick_stream(spark, FOLDER)).drop("closed_at")
    timed("stream_replay", lambda: replay(stream, "bench-stream"), 1, 0)

    # Warm queries on stored data: the marts, the lake, and the mirror of the lake.
    marts = work.marts()
    current = mirror.mirror_scan(spark, copy, lake.schema)
    # Each run builds its query anew: a kept one would reuse its own shuffle output.
    for name, query in {
        "mart_portfolio_summary": lambda: marts.summary.select("*"),
        "mart_volatility_alerts": lambda: marts.alerts.select("*"),
        "mart_latest_window_per_symbol": lambda: asked.latest_facts(marts.facts),
        "mart_kpi_totals": lambda: dashboard.kpi_totals(marts.summary, marts.alerts),
        "lake_full_scan_count": lambda: asked.full_scan_count(lake),
        "lake_session_summary": lambda: asked.scan_summary(lake),
        "lake_latest_per_symbol": lambda: asked.latest_scan(lake),
        "lake_drawdown": lambda: asked.drawdown_vs_session(lake),
        "mirror_full_scan_count": lambda: asked.full_scan_count(current),
        "mirror_session_summary": lambda: asked.scan_summary(current),
        "mirror_latest_per_symbol": lambda: asked.latest_scan(current),
    }.items():
        timed(name, lambda query=query: query().collect(), WARM_RUNS, WARMUP)
    timed("vwap_facts", lambda: to_nowhere(models.vwap_facts(marts.staged)), RUNS, 1)

    print(
        json.dumps(
            {
                "metric": "sum of median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

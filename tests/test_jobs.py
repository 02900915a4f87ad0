import json
import time

import pytest

from pyspark.errors import AnalysisException

from tickloom import jobs
from tickloom.operators.positions import portfolio_value
from tickloom.session import scratch_path
from tickloom.sources import kafka
from tickloom.sources.lake import lake_scan, write_lake
from tickloom.schemas import POSITION
from tickloom.operators.models import stg_windows
from tickloom.sources.positions import load_positions
from tickloom.sources.ticks import decode_ticks
from tickloom.streaming.archive import archive_writer, quarantined
from tickloom.streaming.sinks import file_writer, start


# The demo portfolio: symbol, shares held, average cost, volatility.
DEMO_PORTFOLIO = [
    ("AAPL", 500, 172.50, 0.015), ("MSFT", 300, 415.00, 0.012), ("NVDA", 150, 820.00, 0.028),
    ("GOOGL", 200, 170.00, 0.014), ("META", 180, 490.00, 0.020), ("TSLA", 100, 195.00, 0.035),
    ("SPY", 400, 510.00, 0.008), ("QQQ", 250, 440.00, 0.010),
]


@pytest.fixture(scope="module")
def lake(spark, five_rows):
    path = scratch_path(spark, "lake")
    write_lake(five_rows, path)
    return path


def run(spark, *argv):
    args = jobs.parser().parse_args([str(a) for a in argv])
    args.run(spark, args)


def test_batch_jobs(spark, lake, capsys):
    run(spark, "marts", "--lake", lake, "--database", "marts_job")
    out = scratch_path(spark, "served")
    run(spark, "serve", "--database", "marts_job", "--out", out)
    served = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert {(r["section"], r["symbol"]) for r in served} >= {("portfolio", "TSLA"), ("alerts", "TSLA")}
    assert json.loads(served[0]["record"])["symbol"]

    run(spark, "mirror", "--lake", lake, "--target", scratch_path(spark, "mirror"))
    assert "'row_count': 5" in capsys.readouterr().out

    trend = scratch_path(spark, "trend")
    run(spark, "report", "--lake", lake, "--out", trend)
    assert spark.read.parquet(trend).count() == 5


def test_ask_job(spark, lake):
    run(spark, "marts", "--lake", lake, "--database", "marts_ask")
    questions, out = scratch_path(spark, "questions"), scratch_path(spark, "prompts")
    spark.createDataFrame([("volatility rank of TSLA?",), ("drawdown of NVDA",)], "value string").write.text(questions)
    collection = scratch_path(spark, "collection")
    run(spark, "ingest", "--database", "marts_ask", "--collection", collection)
    run(
        spark.newSession(), "ask", "--collection", collection, "--questions", questions, "--hits", 2, "--out", out,
    )
    prompts = spark.read.json(out).collect()
    assert len(prompts) == 2 and all("Question: " in p.user_text for p in prompts)


def test_check_job_reports_and_fails(spark, lake, capsys):
    run(spark, "marts", "--lake", lake, "--database", "marts_check")
    out = scratch_path(spark, "data-tests")
    run(spark, "check", "--database", "marts_check", "--out", out)
    assert spark.read.parquet(out).where("failures > 0").count() == 0
    broken = spark.table("marts_check.portfolio_summary").selectExpr("*").union(spark.table("marts_check.portfolio_summary"))
    broken.write.saveAsTable("marts_check.broken")
    spark.sql("CREATE OR REPLACE VIEW marts_check.portfolio_summary AS SELECT * FROM marts_check.broken")
    with pytest.raises(SystemExit, match="data tests"):
        run(spark, "check", "--database", "marts_check")


def test_a_bad_refresh_leaves_the_published_mart(spark):
    from tickloom.operators.quality import ContractError
    from tickloom.plans.marts import publish_table
    from tickloom.schemas import SUMMARY_CONTRACT

    spark.sql("CREATE DATABASE IF NOT EXISTS marts_safe")
    kinds = {"string": "x", "bigint": 1, "double": 0.5}

    def rows(*symbols):
        made = [tuple(s if f.name == "symbol" else kinds.get(f.dataType.simpleString()) for f in SUMMARY_CONTRACT.schema) for s in symbols]
        return spark.createDataFrame(made, SUMMARY_CONTRACT.schema)

    def published():
        return sorted(r.symbol for r in spark.table("marts_safe.portfolio_summary").collect())

    publish_table(rows("A", "B"), SUMMARY_CONTRACT, "marts_safe")
    with pytest.raises(ContractError):
        publish_table(rows("C", "C"), SUMMARY_CONTRACT, "marts_safe")
    assert published() == ["A", "B"]
    with pytest.raises(Exception, match="must not be null"):
        publish_table(rows("D", None), SUMMARY_CONTRACT, "marts_safe")
    assert published() == ["A", "B"]
    publish_table(rows("E"), SUMMARY_CONTRACT, "marts_safe")
    publish_table(rows("F"), SUMMARY_CONTRACT, "marts_safe")
    assert published() == ["F"]


def test_positions_and_compact_jobs(spark, lake):
    held, trades, out, target = (scratch_path(spark, n) for n in ("held", "trades", "valued", "compacted"))
    spark.createDataFrame(DEMO_PORTFOLIO, POSITION).write.parquet(held)
    spark.sql(
        "SELECT 'BUY' AS event_type, 'SPY' AS symbol, 10L AS shares, 500.5D AS price, 'p' AS portfolio_id, "
        "TIMESTAMP '2026-05-10 01:00:00' AS ts"
    ).write.parquet(trades)
    run(spark, "positions", "--trades", trades, "--positions", held, "--out", out)
    event = json.loads(spark.read.parquet(f"{out}/events").first().value)
    assert (event["symbol"], event["notional"], event["metadata"]["avg_cost"]) == ("SPY", 5005.0, 510.0)
    assert spark.read.parquet(f"{out}/value").first().positions == 8
    run(spark, "compact", "--lake", lake, "--target", target)
    assert sorted(lake_scan(spark, target).collect()) == sorted(lake_scan(spark, lake).collect())


def test_jobs_name_their_needs(capsys):
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["stream", "--servers", "host:9092"])
    assert "--lake" in capsys.readouterr().err


def test_positions(spark):
    path = scratch_path(spark, "positions")
    spark.createDataFrame(DEMO_PORTFOLIO, POSITION).write.parquet(path)
    ticks = spark.createDataFrame([("SPY", 500.0, None)], "symbol string, price double, ts timestamp")
    row = portfolio_value(ticks, load_positions(spark, path)).first()
    cost = sum(s * c for s, c in [(500, 172.5), (300, 415), (150, 820), (200, 170), (180, 490), (100, 195), (250, 440)])
    assert (row.positions, row.market_value) == (8, cost + 400 * 500.0)


def test_topics_pass_their_options_on(spark):
    messages = spark.readStream.format("rate").load().selectExpr("'k' as key", "'v' as value")
    kafka.topic_writer(messages, "host:9092", scratch_path(spark, "checkpoint"))  # not started
    with pytest.raises(AnalysisException, match="kafka"):  # the package is not installed here
        kafka.topic_stream(spark, "host:9092")


def test_streams_run_together(spark):
    """Lake, quarantine and alerts at once, over messages that arrive while they run."""
    raw, lake, archive, state, sent, rebuilt = (
        scratch_path(spark, n) for n in ("raw", "lake", "archive", "state", "sent", "rebuilt")
    )

    def arrive(*prices):
        rows = [
            (json.dumps({"symbol": "A", "price": p, "size": 1, "timestamp": f"2026-05-10T{hour:02}:00:00+00:00"}),)
            for hour, p in prices
        ]
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(raw)

    arrive((1, 100.0), (2, 100.0), (2, "bad"))
    streams = jobs.start_streams(
        spark.readStream.text(raw),
        lake,
        archive,
        state,
        lambda alerts, checkpoint: file_writer(alerts, sent, checkpoint),
        every="1 second",
    )
    try:
        for stream in streams:
            stream.processAllAvailable()
        arrive((3, 90.0), (4, 99.0), (5, 99.0))
        streams[0].processAllAvailable()
        deadline = time.time() + 120
        while lake_scan(spark, lake).count() < 4 and time.time() < deadline:
            time.sleep(1)
        streams[2].processAllAvailable()
    finally:
        for stream in streams:
            stream.stop()
    assert lake_scan(spark, lake).count() == 4  # the fifth window is still open
    alerts = [json.loads(r.value) for r in spark.read.parquet(sent).collect()]
    marked = {a["window_start"][11:13]: a.get("drawdown_pct") for a in alerts}
    assert marked == {"01": None, "02": None, "03": 10.0, "04": None}
    schema = spark.read.parquet(archive).drop("rejected", "day").schema
    rejected = quarantined(spark, archive, schema).collect()
    assert [(r.reject_reason, json.loads(r.value)["price"]) for r in rejected] == [("bad price", "bad")]

    # A tick that comes too late for the stream is archived, and its day can be built again.
    arrive((1, 50.0))
    start(archive_writer(decode_ticks(spark.readStream.text(raw)), archive, f"{state}/archive"), once=True).awaitTermination()
    run(spark, "rebuild", "--archive", archive, "--target", rebuilt, "--first-day", "2026-05-10", "--last-day", "2026-05-10")
    whole = {r.window_start.hour: (r.trade_count, r.min_price) for r in lake_scan(spark, rebuilt).collect()}
    assert whole == {1: (2, 50.0), 2: (1, 100.0), 3: (1, 90.0), 4: (1, 99.0), 5: (1, 99.0)}
    staged = {r.window_start.hour: r.trade_count for r in stg_windows(lake_scan(spark, lake, rebuilt)).collect()}
    assert staged == {1: 2, 2: 1, 3: 1, 4: 1, 5: 1}

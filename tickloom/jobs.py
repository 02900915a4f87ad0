"""Jobs for ``spark-submit``: stream ticks, build and test marts, refresh the mirror, report,
value positions, compact the lake, ingest documents and ask them.

``python -m tickloom.jobs <job> --help`` lists the options; submitted as a script it takes the
same ones. The session takes master, memory and ``spark.checkpoint.dir`` from the cluster's
configuration.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators import session_queries as asked
from tickloom.operators.documents import render_docs
from tickloom.operators.models import alerts_in_order
from tickloom.operators.retrieval import (
    build_prompts,
    ingest_docs,
    load_vectorizer,
    read_collection,
    topk_cosine,
    vectorize,
)
from tickloom.operators.positions import portfolio_value, position_pnl
from tickloom.operators.quality import contract_tests
from tickloom.operators.windows import DEFAULT_WIDTH
from tickloom.plans.marts import build_mart_tables, read_marts, serve_portfolio
from tickloom.schemas import (
    ALERT_CONTRACT,
    FACT_CONTRACT,
    STAGING_CONTRACT,
    SUMMARY_CONTRACT,
)
from tickloom.session import build_session, store
from tickloom.sources.kafka import ALERT_TOPIC, TICK_TOPIC, topic_stream, topic_writer
from tickloom.sources.lake import compact_lake, lake_scan, lake_stream, load_lake
from tickloom.sources.mirror import mirror_refresh
from tickloom.sources.positions import load_positions
from tickloom.sources.ticks import alert_messages, decode_ticks, encode_events
from tickloom.streaming.archive import archive_stream, archive_writer, rebuild_days
from tickloom.streaming.drawdown import stream_drawdown
from tickloom.streaming.sinks import FLUSH_INTERVAL, lake_writer, start
from tickloom.streaming.windows import DEFAULT_DELAY, stream_windows


def start_streams(
    messages: DataFrame,
    lake: str,
    archive: str,
    checkpoints: str,
    alert_writer: Callable[[DataFrame, str], DataStreamWriter],
    width: str = DEFAULT_WIDTH,
    delay: str = DEFAULT_DELAY,
    every: str = FLUSH_INTERVAL,
) -> list[StreamingQuery]:
    """Tick messages into the archive, the archive into the lake, the lake into the alert sink.

    Each message is read and parsed once, and archived whether it can be used or not; rejected
    ones lie there with the reason (``quarantined``), late ones for ``rebuild_days``. Ticks are
    windowed once. ``alert_writer`` turns alert messages and a checkpoint folder into a writer.
    """
    spark = messages.sparkSession
    decoded = decode_ticks(messages)
    to_archive = start(archive_writer(decoded, archive, f"{checkpoints}/archive"), every=every)
    windows = stream_windows(archive_stream(spark, archive, decoded.schema), width, delay)
    to_lake = start(lake_writer(windows, lake, f"{checkpoints}/lake"), every=every)
    alerts = alert_messages(stream_drawdown(lake_stream(spark, lake)))
    to_alerts = start(alert_writer(alerts, f"{checkpoints}/alerts"), every=every)
    return [to_archive, to_lake, to_alerts]


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Ticks from a topic into the archive, the lake and the alert topic."""
    start_streams(
        topic_stream(spark, args.servers, args.topic),
        args.lake,
        args.archive,
        args.checkpoints,
        lambda alerts, state: topic_writer(alerts, args.servers, state, args.alert_topic),
        args.width,
        args.delay,
    )
    spark.streams.awaitAnyTermination()


def run_rebuild(spark: SparkSession, args: argparse.Namespace) -> None:
    """Windows of whole days from the archive, late ticks included, into a lake root of their own."""
    schema = spark.read.parquet(args.archive).drop("rejected", "day").schema
    rebuild_days(spark, args.archive, schema, args.target, args.first_day, args.last_day, args.width)


def run_marts(spark: SparkSession, args: argparse.Namespace) -> None:
    """All marts from one or more lake roots, for instance the stream's and the rebuilt days'."""
    build_mart_tables(lake_scan(spark, *args.lake), args.database)


def run_mirror(spark: SparkSession, args: argparse.Namespace) -> None:
    print(mirror_refresh(lake_scan(spark, args.lake), args.target, args.format))


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """The session questions, printed; the listing of all windows goes to ``--out``."""
    lake = load_lake(spark, args.format, args.lake)
    asked.session_summary(lake).orderBy(F.desc("avg_volatility")).show(truncate=False)
    asked.latest_window(lake).orderBy(F.desc("volatility")).show(truncate=False)
    asked.drawdown_vs_session(lake).orderBy(F.desc("drawdown_pct")).show(truncate=False)
    if args.out:
        asked.volatility_trend(lake).write.mode("overwrite").parquet(args.out)


def run_serve(spark: SparkSession, args: argparse.Namespace) -> None:
    """Both marts as JSON lines, and the alerts in order."""
    marts = read_marts(spark, args.database)
    serve_portfolio(marts.summary, marts.alerts).write.mode("overwrite").json(args.out)
    alerts_in_order(marts.alerts).show(truncate=False)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rebuild the document collection, and the model of its vectors, from the marts."""
    marts = read_marts(spark, args.database)
    ingest_docs(render_docs(marts.summary, marts.alerts, marts.facts), args.collection)


def run_ask(spark: SparkSession, args: argparse.Namespace) -> None:
    """Ask the stored collection: one prompt per line of ``--questions``."""
    model = load_vectorizer(spark, args.collection)
    stored = read_collection(spark, args.collection).withColumnRenamed("id", "doc_id")
    questions: DataFrame = spark.read.text(args.questions).select(
        F.xxhash64("value").alias("query_id"), F.col("value").alias("question")
    )
    texts = questions.withColumnRenamed("question", "text")
    if model is None:  # an empty collection answers no question
        asked_vectors = texts.withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        asked_vectors = vectorize(model, texts)
    hits = topk_cosine(asked_vectors, stored, args.hits, args.query_blocks, args.doc_blocks)
    build_prompts(questions, hits, stored).write.mode("overwrite").json(args.out)


def run_check(spark: SparkSession, args: argparse.Namespace) -> None:
    """All data tests on the published marts; the job fails if a test does.

    The report, one row per test, goes to ``--out`` if given, and what failed is printed.
    """
    marts = read_marts(spark, args.database)
    relations = zip(
        (marts.staged, marts.facts, marts.summary, marts.alerts),
        (STAGING_CONTRACT, FACT_CONTRACT, SUMMARY_CONTRACT, ALERT_CONTRACT),
        strict=True,
    )
    tests = [contract_tests(df, contract) for df, contract in relations]
    report = store(reduce(DataFrame.unionByName, tests), "data-tests")
    if args.out:
        report.write.mode("overwrite").parquet(args.out)
    failed = report.where("failures > 0")
    if not failed.isEmpty():
        failed.show(truncate=False)
        raise SystemExit("data tests failed")


def run_positions(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trades valued against positions: enriched events as messages, and the market value."""
    held = load_positions(spark, args.positions)
    trades = spark.read.parquet(args.trades)
    events = position_pnl(trades, held)
    encode_events(events).write.mode("overwrite").parquet(f"{args.out}/events")
    portfolio_value(trades, held).write.mode("overwrite").parquet(f"{args.out}/value")


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """The lake rewritten with few, well-sized files per date at ``--target``."""
    compact_lake(lake_scan(spark, args.lake), args.target)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickloom.jobs", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *options: tuple[str, dict]):
        sub = jobs.add_parser(name, help=run.__doc__)
        for flag, settings in options:
            sub.add_argument(flag, **settings)
        sub.add_argument("--shuffle-partitions", type=int, help="about shuffled bytes / 200 MB")
        sub.set_defaults(run=run)

    needed: dict = {"required": True}
    lake, out = ("--lake", needed), ("--out", needed)
    database = ("--database", {"default": "marts"})
    job(
        "stream",
        run_stream,
        ("--servers", needed),
        lake,
        ("--archive", needed),
        ("--checkpoints", needed),
        ("--topic", {"default": TICK_TOPIC}),
        ("--alert-topic", {"default": ALERT_TOPIC}),
        ("--width", {"default": DEFAULT_WIDTH}),
        ("--delay", {"default": DEFAULT_DELAY}),
    )
    job("marts", run_marts, ("--lake", {"required": True, "nargs": "+"}), database)
    job(
        "rebuild",
        run_rebuild,
        ("--archive", needed),
        ("--target", needed),
        ("--first-day", needed),
        ("--last-day", needed),
        ("--width", {"default": DEFAULT_WIDTH}),
    )
    fmt = ("--format", {"default": "parquet"})
    job("mirror", run_mirror, lake, ("--target", needed), fmt)
    job("report", run_report, lake, fmt, ("--out", {}))
    job("serve", run_serve, database, out)
    collection = ("--collection", needed)
    job("ingest", run_ingest, database, collection)
    job("check", run_check, database, ("--out", {}))
    job("positions", run_positions, ("--trades", needed), ("--positions", needed), out)
    job("compact", run_compact, lake, ("--target", needed))
    job(
        "ask",
        run_ask,
        collection,
        ("--questions", needed),
        ("--hits", {"type": int, "default": 5}),
        ("--query-blocks", {"type": int, "help": "by the number of questions, unless given"}),
        ("--doc-blocks", {"type": int, "help": "by the size of the collection, unless given"}),
        out,
    )
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    settings = {}
    if args.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    args.run(build_session(f"tickloom-{args.job}", **settings), args)


if __name__ == "__main__":
    main()

"""Every operator as a query over the tables of one input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.risk import utc_date, volatility_regime
from tickloom.operators import dashboard, documents, models, percentiles, positions, quality, retrieval
from tickloom.operators import session_queries as asked
from tickloom.operators.nearest import approximate_topk
from tickloom.operators.ordered import positions as in_order
from tickloom.operators.windows import vwap_windows, window_open_close
from tickloom.plans.marts import ALERT_ORDER, build_mart_tables, read_marts, serve_in_order, serve_portfolio
from tickloom.plans.workspace import Workspace
from tickloom.schemas import (
    ALERT_CONTRACT,
    ALERT_MESSAGE,
    FACT_CONTRACT,
    STAGING_CONTRACT,
    SUMMARY_CONTRACT,
    WINDOW,
    Contract,
)
from tickloom.session import prepare, scratch_path, store
from tickloom.sources import inputs, lake, mirror, ticks
from tickloom.streaming import archive, live
from tickloom.streaming.drawdown import stream_drawdown
from tickloom.streaming.sinks import file_writer, lake_writer, replay, start
from tickloom.streaming.silent import replay_until_silent, stream_silent_windows
from tickloom.streaming.windows import stream_windows

Query = Callable[[SparkSession, str], DataFrame]

# Questions asked of the document collection; the collection grows with the input.
QUESTIONS = (
    (1, "Which symbol has the highest volatility rank?"),
    (2, "What is the max drawdown and session high of purchase?"),
    (3, "Which alerts are DRAWDOWN alerts?"),
    (4, "   "),
)


# Symbols asked for; the documents grow with the input.
SYMBOLS_ASKED = ((1, "click"), (2, "no such symbol"), (3, "   "), (4, "purchase"))


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall clock, the form the SQL check compares."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks to windows to lake to facts to ordered alerts."""
    return naive(models.alerts_in_order(Workspace(spark, folder).marts().alerts))


def _on_lake(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: naive(operator(Workspace(spark, folder).lake()))


def _on_marts(operator) -> Query:
    return lambda spark, folder: naive(operator(Workspace(spark, folder).marts()))


def _symbols(summary: DataFrame) -> list[str]:
    """All symbols, one column each in the wide chart; the summary has a row per symbol."""
    return sorted(r.symbol for r in summary.select("symbol").collect())


def _on_ticks(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: naive(operator(inputs.event_ticks(prepare(spark), folder)))


# --- lake -------------------------------------------------------------------------------


def _late_fragments(windows: DataFrame) -> DataFrame:
    """The lake plus an earlier, partial fragment of each window with several trades."""
    partial = windows.filter(F.col("trade_count") > 1).select(
        *[
            {
                "window_end": F.expr("window_end - interval 1 minute"),
                "trade_count": F.col("trade_count") - 1,
            }.get(c, F.col(c)).alias(c)
            for c in windows.columns
        ]
    )
    return lake.lake_union(windows, partial)


def _scanned(windows: DataFrame) -> DataFrame:
    return windows.select(*WINDOW.fieldNames(), F.date_format("date", "yyyy-MM-dd").alias("date"))


# --- suppliers: many symbols, daily windows over years ----------------------------------


def _supplier_windows(spark: SparkSession, folder: str) -> DataFrame:
    ticks_in = inputs.lineitem_ticks(prepare(spark), folder)
    return naive(vwap_windows(ticks_in, "1 day"))


def _enriched_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    windows = vwap_windows(inputs.lineitem_ticks(prepare(spark), folder), "1 day")
    return models.vwap_facts(store(windows, "supplier-windows"))


def _supplier_facts(spark: SparkSession, folder: str) -> DataFrame:
    return naive(_enriched_suppliers(spark, folder))


def _supplier_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return naive(models.volatility_alerts(_enriched_suppliers(spark, folder), threshold=90.0))


# --- messages ---------------------------------------------------------------------------


def _decode_ticks(spark: SparkSession, folder: str) -> DataFrame:
    decoded = ticks.decode_ticks(inputs.event_messages(prepare(spark), folder))
    return naive(
        decoded.select("event_id", "symbol", "price", "size", "ts", "exchange", "reject_reason")
    )


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    messages = inputs.event_messages(prepare(spark), folder)
    _, bad = ticks.split_ticks(ticks.decode_ticks(messages))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


def _encode_ticks(spark: SparkSession, folder: str) -> DataFrame:
    sent = ticks.normalize_ticks(
        inputs.event_ticks(prepare(spark), folder).withColumnRenamed("ts", "timestamp"), "events"
    )
    good, _ = ticks.split_ticks(ticks.decode_ticks(ticks.encode_ticks(sent)))
    return naive(good.select("key", "symbol", "price", "size", "ts", "source", "exchange"))


def _normalize_ticks(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(prepare(spark), folder, "events")
    trades = events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("size"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")).alias(
            "timestamp"
        ),
    )
    normal = ticks.normalize_ticks(trades, "events")
    return naive(normal.withColumn("conditions", F.size("conditions")))


def _stored_percentiles(ticks: DataFrame) -> DataFrame:
    """Percentiles per symbol from sketches kept per symbol and UTC day."""
    sketches = store(percentiles.value_sketches(ticks, ["symbol", utc_date(F.col("ts")).alias("day")], "price"), "sketches")
    found = percentiles.exact_percentiles(ticks, sketches, "symbol", "price")
    return found.select("symbol", "row_count", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


def _alert_messages(spark: SparkSession, folder: str) -> DataFrame:
    marked = models.stream_highs(Workspace(spark, folder).lake().drop("date"))
    message = F.from_json("value", ALERT_MESSAGE)
    return (
        ticks.alert_messages(marked).select("key", message.alias("m")).select("key", "m.*")
    )


def _pnl(spark: SparkSession, folder: str) -> DataFrame:
    spark = prepare(spark)
    return positions.position_pnl(
        inputs.lineitem_trades(spark, folder), inputs.part_positions(spark, folder)
    )


def _decode_events(spark: SparkSession, folder: str) -> DataFrame:
    return naive(ticks.decode_events(ticks.encode_events(_pnl(spark, folder))))


def _portfolio_value(spark: SparkSession, folder: str) -> DataFrame:
    spark = prepare(spark)
    trades = inputs.lineitem_trades(spark, folder)
    return positions.portfolio_value(trades, inputs.part_positions(spark, folder))


def _live_pnl(spark: SparkSession, folder: str) -> DataFrame:
    """The trades as a stream; each batch meets the positions as they are read then."""
    spark = prepare(spark)
    path, state = scratch_path(spark, "live-pnl"), scratch_path(spark, "live-pnl-state")
    stream = inputs.lineitem_trade_stream(spark, folder)
    writer = live.live_pnl_writer(stream, lambda: inputs.part_positions(spark, folder), path, state)
    start(writer, once=True).awaitTermination()
    return naive(live.published(spark, path, _pnl(spark, folder).schema).drop(live.BATCH))


def _live_portfolio_value(spark: SparkSession, folder: str) -> DataFrame:
    spark = prepare(spark)
    path, state = scratch_path(spark, "live-prices"), scratch_path(spark, "live-prices-state")
    stream = inputs.lineitem_trade_stream(spark, folder)
    start(live.live_prices_writer(stream, path, state), once=True).awaitTermination()
    return live.live_portfolio_value(spark, path, inputs.part_positions(spark, folder))


# --- catalog ----------------------------------------------------------------------------


def _database(spark: SparkSession) -> str:
    """A database of this call, whose tables lie in the shared folder."""
    path = scratch_path(prepare(spark), "catalog")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _mart_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Marts published as catalog tables, and read back by name."""
    database = _database(spark)
    build_mart_tables(Workspace(spark, folder).lake(), database)
    return naive(read_marts(spark, database).facts)


def _table_lake(spark: SparkSession, folder: str) -> DataFrame:
    """The lake behind a table name."""
    table = f"{_database(spark)}.lake"
    Workspace(spark, folder).lake().write.partitionBy("date").saveAsTable(table)
    return naive(asked.scan_summary(lake.load_lake(spark, "table", table)))


# --- quality ----------------------------------------------------------------------------


def _relations(spark: SparkSession, folder: str):
    marts = Workspace(spark, folder).marts()
    return (
        (marts.staged, STAGING_CONTRACT),
        (marts.facts, FACT_CONTRACT),
        (marts.summary, SUMMARY_CONTRACT),
        (marts.alerts, ALERT_CONTRACT),
    )


def _dq_report(spark: SparkSession, folder: str) -> DataFrame:
    relations = _relations(spark, folder)
    return quality.dq_report(relations, inputs.event_ticks(spark, folder))


def _damaged(windows: DataFrame) -> DataFrame:
    """Lake rows that break the data tests: missing fields, negative values, repeated keys."""
    rows = _late_fragments(windows.drop("date"))
    broken = {
        "symbol": F.when(F.col("total_volume") != 0, F.col("symbol")),
        "vwap": F.when(F.col("trade_count") <= 1, F.col("vwap")),
        "volatility": -F.col("volatility"),
    }
    return rows.select(*[broken.get(c, F.col(c)).alias(c) for c in rows.columns])


DAMAGED_CONTRACT = Contract(
    name="damaged_windows",
    schema=WINDOW,
    tested_not_null=STAGING_CONTRACT.tested_not_null,
    key=("symbol", "window_start"),
)


def _contract_check(spark: SparkSession, folder: str) -> DataFrame:
    _, facts, summary, alerts = _relations(spark, folder)
    checks = [quality.contract_check(df, contract) for df, contract in (facts, summary, alerts)]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


# --- mirror -----------------------------------------------------------------------------


def _mirror(spark: SparkSession, folder: str) -> tuple[DataFrame, dict, str]:
    windows = Workspace(spark, folder).lake()
    target = scratch_path(spark, "mirror")
    return windows, mirror.mirror_refresh(windows, target), target


def _mirror_refresh(spark: SparkSession, folder: str) -> DataFrame:
    _, _, target = _mirror(spark, folder)
    return mirror.mirror_log(spark, target).select("row_count")


def _mirror_scan(spark: SparkSession, folder: str) -> DataFrame:
    windows, _, target = _mirror(spark, folder)
    return naive(asked.scan_summary(mirror.mirror_scan(spark, target, windows.schema)))


def _mirror_parity(spark: SparkSession, folder: str) -> DataFrame:
    """The lake against its mirror, and against it again once late fragments have come in."""
    windows, _, target = _mirror(spark, folder)
    windows = windows.drop("date")
    copy = mirror.mirror_scan(spark, target, Workspace(spark, folder).lake().schema).drop("date")
    day = utc_date(F.col("window_start"))
    fresh = mirror.mirror_parity(windows, copy, day).withColumn("lake", F.lit("mirrored"))
    grown = mirror.mirror_parity(_late_fragments(windows), copy, day)
    return fresh.unionByName(grown.withColumn("lake", F.lit("grown")))


# --- documents and retrieval ------------------------------------------------------------


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    marts = Workspace(spark, folder).marts()
    return documents.render_docs(marts.summary, marts.alerts, marts.facts)


def _ingested(spark: SparkSession, folder: str):
    path = scratch_path(spark, "collection")
    model = retrieval.ingest_docs(_docs(spark, folder), path)
    return model, retrieval.read_collection(spark, path)


def _ingest_docs(spark: SparkSession, folder: str) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    return _ingested(spark, folder)[1].select(
        "id",
        "text",
        F.col("metadata")["symbol"].alias("symbol"),
        F.col("metadata")["type"].alias("type"),
        F.size("embedding").alias("dimensions"),
        F.round(norm, 4).alias("norm"),
    )


def _build_prompts(spark: SparkSession, folder: str) -> DataFrame:
    model, collection = _ingested(spark, folder)
    questions = spark.createDataFrame(list(QUESTIONS), "query_id bigint, question string")
    asked_vectors = retrieval.vectorize(model, questions.withColumnRenamed("question", "text"))
    docs = collection.withColumnRenamed("id", "doc_id")
    hits = retrieval.topk_cosine(asked_vectors, docs)
    return retrieval.build_prompts(questions, hits, docs)


def _topk_cosine(spark: SparkSession, folder: str) -> DataFrame:
    vectors = inputs.table(spark, folder, "embeddings")
    queries = retrieval.centroids(vectors, "label").withColumnRenamed("label", "query_id")
    docs = vectors.withColumnRenamed("vec_id", "doc_id")
    hits = retrieval.topk_cosine(queries, docs)
    return hits.withColumn("score", F.round("score", 6))


def _approximate_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whose id is divisible by 50, against all vectors."""
    docs = inputs.table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    queries = docs.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    return approximate_topk(queries, docs).withColumn("score", F.round("score", 6))


def _prompt_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts over the documents of the symbol that is asked for; one question has none, one is empty."""
    questions = spark.createDataFrame(list(SYMBOLS_ASKED), "query_id bigint, question string")
    docs = _docs(spark, folder).withColumnRenamed("id", "doc_id")
    by_id = Window.partitionBy("query_id").orderBy("doc_id")
    hits = questions.join(docs, F.col("question") == F.col("symbol")).select(
        "query_id", "doc_id", F.row_number().over(by_id).alias("rank")
    )
    return retrieval.build_prompts(questions, hits.filter(F.col("rank") <= retrieval.HITS), docs)


def _tag_risk_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return documents.tag_risk_tokens(inputs.table(spark, folder, "documents"), "doc_id")


def _tag_document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return documents.tag_risk_tokens(_docs(spark, folder), "id")


def _serve_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """The served JSON records, read back; each list leaves the other's fields empty."""
    marts = Workspace(spark, folder).marts()
    fields = {f.name: f for f in (*SUMMARY_CONTRACT.schema, *ALERT_CONTRACT.schema)}
    record = F.from_json("record", T.StructType(list(fields.values())))
    served = serve_portfolio(marts.summary, marts.alerts)
    read_back = served.select("section", record.alias("r")).select("section", "r.*")
    whole = [f.name for f in fields.values() if isinstance(f.dataType, T.LongType)]
    return naive(read_back.withColumns({name: F.col(name).cast("double") for name in whole}))


# --- streams ----------------------------------------------------------------------------


def _stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    stream = stream_windows(inputs.event_tick_stream(prepare(spark), folder))
    return naive(replay(stream.drop("closed_at"), "stream-windows"))


def _stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    messages = inputs.messages_of_events(inputs.event_stream(prepare(spark), folder))
    _, bad = ticks.split_ticks(ticks.decode_ticks(messages))
    stored = replay(bad, "stream-quarantine")
    return stored.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


def _archived(spark: SparkSession, folder: str) -> tuple[str, T.StructType]:
    """The archive of all messages of the folder, as the stream writes it."""
    messages = inputs.messages_of_events(inputs.event_stream(prepare(spark), folder))
    decoded = ticks.decode_ticks(messages)
    path, state = scratch_path(spark, "archive"), scratch_path(spark, "archive-state")
    start(archive.archive_writer(decoded, path, state), once=True).awaitTermination()
    return path, decoded.schema


def _rejected_messages(spark: SparkSession, folder: str) -> DataFrame:
    path, schema = _archived(spark, folder)
    return archive.quarantined(spark, path, schema)


def _rebuilt_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All days built anew from the archive: no tick is too late for that."""
    path, schema = _archived(spark, folder)
    target = scratch_path(spark, "rebuilt")
    archive.rebuild_days(spark, path, schema, target, *archive.archived_range(spark, path, schema))
    return naive(lake.lake_scan(spark, target).drop("date"))


def _stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    stream = stream_windows(inputs.event_tick_stream(prepare(spark), folder))
    return naive(replay(stream_drawdown(stream), "stream-alerts"))


def _stream_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows as the stream writes them into the lake, read back."""
    stream = stream_windows(inputs.event_tick_stream(prepare(spark), folder))
    path, state = scratch_path(spark, "stream-lake"), scratch_path(spark, "stream-lake-state")
    start(lake_writer(stream, path, state), once=True).awaitTermination()
    return naive(_scanned(lake.lake_scan(spark, path)))


def _stream_silent_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All windows: the last ones close because their symbols fall silent."""
    stream = stream_silent_windows(inputs.event_tick_stream(prepare(spark), folder), idle="5 seconds")
    return naive(replay_until_silent(stream, "silent-windows", "5 seconds"))


def _stored_highs(spark: SparkSession, folder: str) -> DataFrame:
    """Session highs out of the state of a stream over the lake."""
    workspace = Workspace(spark, folder)
    path, state = scratch_path(spark, "tracked"), scratch_path(spark, "tracked-state")
    tracked = stream_drawdown(lake.lake_stream(spark, workspace.lake_path()))
    start(file_writer(tracked, path, state), once=True).awaitTermination()
    return live.stored_highs(spark, state)


def registry() -> dict[str, Query]:
    return {
        # windows
        "vwap_windows": _on_ticks(vwap_windows),
        "vwap_windows_hourly": _on_ticks(lambda t: vwap_windows(t, "1 hour")),
        "window_open_close": _on_ticks(window_open_close),
        # lake
        "lake_scan": _on_lake(_scanned),
        "lake_union": _on_lake(lambda w: _late_fragments(w.drop("date"))),
        "full_scan_count": _on_lake(asked.full_scan_count),
        "windows_per_symbol": _on_lake(asked.windows_per_symbol),
        "symbol_filter": _on_lake(lambda w: asked.symbol_filter(w.drop("date"), "purchase")),
        # models
        "stg_windows": _on_lake(lambda w: models.stg_windows(_late_fragments(w.drop("date")))),
        "vwap_facts": _on_marts(lambda m: m.facts),
        "supplier_windows": _supplier_windows,
        "supplier_facts": _supplier_facts,
        "supplier_alerts": _supplier_alerts,
        "portfolio_summary": _on_marts(lambda m: m.summary.orderBy(F.desc("avg_volatility"))),
        "volatility_alerts": _on_marts(lambda m: models.alerts_in_order(m.alerts)),
        "volatility_regime": _on_marts(
            lambda m: m.summary.select(
                "symbol", volatility_regime(F.col("avg_volatility")).alias("volatility_regime")
            )
        ),
        "window_regimes": _on_lake(
            lambda w: w.groupBy(
                "symbol", volatility_regime(F.col("volatility") / 1000).alias("volatility_regime")
            ).agg(F.count(F.lit(1)).alias("windows"))
        ),
        # session queries
        "session_summary": _on_lake(
            lambda w: asked.session_summary(w).orderBy(F.desc("avg_volatility"))
        ),
        "scan_summary": _on_lake(asked.scan_summary),
        "latest_window": _on_lake(lambda w: asked.latest_window(w).orderBy(F.desc("volatility"))),
        "latest_facts": _on_marts(lambda m: asked.latest_facts(m.facts)),
        "latest_scan": _on_lake(asked.latest_scan),
        "drawdown_vs_session": _on_lake(
            lambda w: asked.drawdown_vs_session(w).orderBy(F.desc("drawdown_pct"))
        ),
        "volatility_trend": _on_lake(
            lambda w: asked.volatility_trend(w).orderBy("symbol", "window_start")
        ),
        "stream_drawdown": _on_lake(lambda w: models.stream_highs(w.drop("date"))),
        # dashboard
        "kpi_totals": _on_marts(lambda m: dashboard.kpi_totals(m.summary, m.alerts)),
        "ticker_strip": _on_marts(lambda m: dashboard.ticker_strip(m.summary)),
        "portfolio_table": _on_marts(lambda m: dashboard.portfolio_table(m.summary)),
        "alerts_feed": _on_marts(lambda m: dashboard.alerts_feed(m.alerts)),
        "midpoint_series": _on_marts(lambda m: dashboard.midpoint_series(m.facts, m.summary)),
        "midpoint_wide": _on_marts(
            lambda m: dashboard.midpoint_wide(
                dashboard.midpoint_series(m.facts, m.summary), _symbols(m.summary)
            )
        ),
        "value_percentiles": _on_ticks(
            lambda t: dashboard.value_percentiles(t, "symbol", "price").select(
                "symbol", "row_count", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")]
            )
        ),
        "stored_percentiles": _on_ticks(_stored_percentiles),
        # positions
        "position_pnl": lambda spark, folder: naive(_pnl(spark, folder)),
        "portfolio_value": _portfolio_value,
        "live_pnl": _live_pnl,
        "live_portfolio_value": _live_portfolio_value,
        # messages
        "decode_ticks": _decode_ticks,
        "quarantined_ticks": _quarantine,
        "decode_events": _decode_events,
        "encode_ticks": _encode_ticks,
        "normalize_ticks": _normalize_ticks,
        "alert_messages": _alert_messages,
        # quality
        "dq_report": _dq_report,
        "contract_check": _contract_check,
        "dq_damaged": _on_lake(lambda w: quality.contract_tests(_damaged(w), DAMAGED_CONTRACT)),
        # catalog
        "mart_tables": _mart_tables,
        "table_lake": _table_lake,
        # mirror
        "mirror_refresh": _mirror_refresh,
        "mirror_scan": _mirror_scan,
        "mirror_parity": _mirror_parity,
        # documents and retrieval
        "render_docs": _docs,
        "ingest_docs": _ingest_docs,
        "topk_cosine": _topk_cosine,
        "approximate_topk": _approximate_topk,
        "prompt_texts": _prompt_texts,
        "build_prompts": _build_prompts,
        "tag_risk_tokens": _tag_risk_tokens,
        "tag_document_tokens": _tag_document_tokens,
        "serve_portfolio": _serve_portfolio,
        "serve_in_order": _on_marts(
            lambda m: serve_in_order(m.summary, m.alerts).select("section", "symbol", "position")
        ),
        "supplier_order": lambda spark, folder: in_order(
            _supplier_alerts(spark, folder), ALERT_ORDER, "position"
        ).select("symbol", "alert_time", "drawdown_pct", "volatility", "position"),
        # streams
        "stream_windows": _stream_windows,
        "stream_alerts": _stream_alerts,
        "stream_silent_windows": _stream_silent_windows,
        "stream_lake": _stream_lake,
        "stored_highs": _stored_highs,
        "stream_quarantine": _stream_quarantine,
        "rejected_messages": _rejected_messages,
        "rebuilt_windows": _rebuilt_windows,
    }

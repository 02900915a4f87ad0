from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import dashboard, retrieval
from tickloom.operators.documents import (
    alert_documents,
    latest_documents,
    render_docs,
    summary_documents,
    tag_risk_tokens,
)
from tickloom.schemas import ALERT_CONTRACT, FACT_CONTRACT, SUMMARY_CONTRACT
from tickloom.session import scratch_path

START, END = datetime(2026, 5, 10, 5, 10), datetime(2026, 5, 10, 5, 22, 13)


@pytest.fixture(scope="module")
def summary(spark):
    row = ("NVDA", 3, 820.05, 819.78, 820.11, 0.33, 0.0538, 0.0862, 903, 232172.0, 0.01, START, END, "HIGH")
    return spark.createDataFrame([row], SUMMARY_CONTRACT.schema)


@pytest.fixture(scope="module")
def alerts(spark):
    row = ("NVDA", END, 820.05, 820.11, 0.01, 0.0293, 1, "HIGHEST_VOL")
    return spark.createDataFrame([row], ALERT_CONTRACT.schema)


@pytest.fixture(scope="module")
def facts(spark):
    row = ("NVDA", START, END, 820.05, 819.78, 820.11, 0.0293, 0.33, 903, 232172.0, 820.11, 0.0073, 1)
    old = ("NVDA", datetime(2026, 5, 9), datetime(2026, 5, 9, 0, 5), *row[3:])
    return spark.createDataFrame([row, old], FACT_CONTRACT.schema)


def test_summary_document(summary):
    row = summary_documents(summary).first()
    assert row.asDict() == {
        "id": "summary_NVDA",
        "symbol": "NVDA",
        "type": "portfolio_summary",
        "text": (
            "Symbol: NVDA\nVolatility Regime: HIGH\nAverage VWAP: $820.05\n"
            "Session Low: $819.78 | Session High: $820.11\nSession Range: $0.33\n"
            "Average Volatility: 0.053800\nPeak Volatility: 0.086200\nMax Drawdown: 0.01%\n"
            "Total Trades: 903\nTotal Volume: $232,172\n"
            "Session Start: 2026-05-10 05:10:00\nLast Updated: 2026-05-10 05:22:13"
        ),
    }


def test_large_and_whole_numbers_print_plainly(summary):
    big = summary.withColumn("avg_vwap", F.lit(12345678.5)).withColumn("session_low", F.lit(100.0))
    text = summary_documents(big).first().text
    assert "Average VWAP: $12345678.5\n" in text and "Session Low: $100.0 |" in text


def test_alert_document(alerts):
    row = alert_documents(alerts).first()
    assert (row.id, row.type) == ("alert_NVDA", "volatility_alert")
    assert row.text == (
        "ALERT — Symbol: NVDA\nAlert Type: HIGHEST_VOL\nCurrent VWAP: $820.05\n"
        "Session High: $820.11\nDrawdown: 0.01%\nVolatility: 0.029300\n"
        "Volatility Rank: #1 across portfolio\nAlert Time: 2026-05-10 05:22:13"
    )


def test_latest_document(facts):
    row = latest_documents(facts).first()
    assert row.text == (
        "Latest 5-min Window — Symbol: NVDA\nVWAP: $820.0500\nVolatility: 0.029300\n"
        "Drawdown from session high: 0.0073%\nSession High: $820.11\n"
        "Window: 2026-05-10 05:10:00 → 2026-05-10 05:22:13"
    )


def test_a_missing_number_does_not_lose_the_document(alerts):
    text = alert_documents(alerts.withColumn("drawdown_pct", F.lit(None).cast("double"))).first().text
    assert "Drawdown: nan%" in text


def test_tokens(spark):
    texts = spark.createDataFrame(
        [(1, "NVDA $1,234.50 is HIGH, rank #2; 3.06% WATCH LOW HIGHEST_VOL"), (2, "none"), (3, None)],
        "id int, text string",
    )
    rows = tag_risk_tokens(texts, "id").orderBy("position").collect()
    assert [(r.token, r.kind) for r in rows] == [
        ("$1,234.50", "money"),
        ("HIGH", "red"),
        ("#2", "rank"),
        ("3.06%", "number"),
        ("WATCH", "amber"),
        ("LOW", "green"),
        ("HIGHEST_VOL", "red"),
    ]


def test_word_ends_are_ascii(spark):
    texts = spark.createDataFrame([(1, "éHIGH LOWé xLOW HIGH_ HIGHEST_VOL2 WATCH. DRAWDOWN")], "id int, text string")
    rows = tag_risk_tokens(texts, "id").orderBy("position").collect()
    assert [r.token for r in rows] == ["HIGH", "LOW", "WATCH", "DRAWDOWN"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).astype("float32").tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]  # a large group of equal vectors
    rows.append((2000, [0.0] * 16))
    return spark.createDataFrame(rows, "doc_id bigint, embedding array<float>").repartition(6)


def brute_force(queries, docs, k):
    def unit(v):
        v = np.asarray(v, dtype="float64")
        n = np.linalg.norm(v)
        return v / n if n else v

    found = {}
    for q in queries.collect():
        scored = [(-round(float(unit(q.embedding) @ unit(d.embedding)), 9), d.doc_id) for d in docs.collect()]
        found[q.query_id] = [doc for _, doc in sorted(scored)[:k]]
    return found


@pytest.mark.parametrize("blocks", [(1, None), (4, 9), (1, 1)])
def test_topk_is_exact_for_any_blocks(vectors, blocks):
    queries = vectors.filter("doc_id < 30").withColumnRenamed("doc_id", "query_id")
    hits = retrieval.topk_cosine(queries, vectors, k=5, query_blocks=blocks[0], doc_blocks=blocks[1])
    got = {}
    for row in hits.orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.doc_id)
    assert got == brute_force(queries, vectors, 5)


def test_blocks_follow_the_size_of_the_table(vectors):
    width = vectors.selectExpr("sum(size(embedding)) * 8").first()[0]
    assert retrieval.block_count(vectors, width) == 1 and retrieval.block_count(vectors, width // 3) >= 3
    assert retrieval.block_count(vectors.filter("false")) == 1
    queries = vectors.filter("doc_id < 6").withColumnRenamed("doc_id", "query_id")
    small = {tuple(r) for r in retrieval.topk_cosine(queries, vectors, block_bytes=64).collect()}
    assert small == {tuple(r) for r in retrieval.topk_cosine(queries, vectors).collect()}


def test_topk_with_fewer_documents_than_k(vectors):
    queries = vectors.filter("doc_id = 1").withColumnRenamed("doc_id", "query_id")
    assert retrieval.topk_cosine(queries, vectors.filter("doc_id < 3")).count() == 3
    assert retrieval.topk_cosine(queries.filter("false"), vectors).count() == 0


def test_vectors_that_cannot_be_compared_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [1.0, 0.0, 0.0]), (5, None), (6, []), (7, [0.5, 0.5]), (8, [1.0, None])]
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<float>")
    queries = docs.withColumnRenamed("doc_id", "query_id")
    hits = {(r.query_id, r.doc_id): round(r.score, 6) for r in retrieval.topk_cosine(queries, docs).collect()}
    assert hits == {(1, 1): 1.0, (1, 7): 0.707107, (7, 1): 0.707107, (7, 7): 1.0, (4, 4): 1.0}
    left_out = {r.doc_id: r.reason for r in retrieval.unusable_vectors(docs).collect()}
    assert left_out == {2: "not finite", 3: "not finite", 5: "no vector", 6: "no vector", 8: "not finite"}


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 4.0])], "label int, embedding array<float>")
    assert {r.label: r.embedding for r in retrieval.centroids(df, "label").collect()} == {
        1: [0.5, 0.5],
        2: [3.0, 4.0],
    }


def test_retrieval_end_to_end(spark, summary, alerts, facts):
    others = summary.withColumn("symbol", F.lit("SPY")).withColumn("volatility_regime", F.lit("LOW"))
    docs = render_docs(summary.unionByName(others), alerts, facts)
    path = scratch_path(spark, "collection")
    model = retrieval.ingest_docs(docs, path)
    retrieval.ingest_docs(docs, path)  # a rebuild replaces
    collection = retrieval.read_collection(spark, path)
    assert collection.count() == 4
    assert collection.filter("id = 'alert_NVDA'").first().metadata == {"symbol": "NVDA", "type": "volatility_alert"}
    assert len(collection.first().embedding) == retrieval.DIMENSIONS

    questions = spark.createDataFrame(
        [(1, "alert type of NVDA?"), (2, "regime of SPY"), (3, "  ")], "query_id int, question string"
    )
    texts = questions.withColumnRenamed("question", "text")
    asked = retrieval.vectorize(retrieval.load_vectorizer(spark, path), texts)
    assert asked.collect() == retrieval.vectorize(model, texts).collect()
    stored = collection.withColumnRenamed("id", "doc_id")
    hits = retrieval.topk_cosine(asked, stored, k=2)
    first = {r.query_id: r.doc_id for r in hits.filter("rank = 1").collect()}
    assert first[1] == "alert_NVDA" and first[2] == "summary_SPY"

    prompts = {r.query_id: r for r in retrieval.build_prompts(questions, hits, stored).collect()}
    assert set(prompts) == {1, 2}
    assert prompts[1].user_text.startswith("Documents:\n\nALERT — Symbol: NVDA")
    assert prompts[1].user_text.endswith("\n\nQuestion: alert type of NVDA?")
    assert prompts[1].user_text.count(retrieval.CONTEXT_SEPARATOR) == 1
    assert prompts[1].fallback is None

    nothing = retrieval.build_prompts(questions, hits.filter("false"), stored).first()
    assert nothing.user_text is None and nothing.fallback == retrieval.NO_DATA_TEXT


def test_dashboard_figures(spark, summary, alerts, facts):
    kpi = dashboard.kpi_totals(summary, alerts).first().asDict()
    assert kpi == {
        "total_trades": 903, "total_volume_millions": 0.23, "symbols": 1,
        "high_regime": 1, "medium_regime": 0, "active_alerts": 1,
    }
    strip = dashboard.ticker_strip(summary).first()
    assert (strip.price, strip.change_pct, strip.direction) == (820.05, 0.04, "UP")
    series = dashboard.midpoint_series(facts, summary)
    points = {r.point: r.pct_from_mid for r in series.collect()}
    assert points == {"T-0": 0.0128, "T-1": 0.0128}
    wide = dashboard.midpoint_wide(series, ["NVDA", "SPY"]).orderBy("point").collect()
    assert [(r.point, r.NVDA, r.SPY) for r in wide] == [("T-0", 0.0128, None), ("T-1", 0.0128, None)]


def test_kpi_of_empty_marts(summary, alerts):
    row = dashboard.kpi_totals(summary.filter("false"), alerts.filter("false")).first()
    assert (row.total_trades, row.symbols, row.active_alerts) == (0, 0, 0)

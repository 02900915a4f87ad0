"""Approximate nearest vectors against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import nearest
from tickloom.operators.nearest import approximate_topk, candidate_pairs, hash_planes, recall
from tickloom.operators.retrieval import topk_cosine


def frame(spark, rows, key="doc_id"):
    return spark.createDataFrame(rows, f"{key} long, embedding array<double>")


def clustered(n, width=24, clusters=40, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((clusters, width))
    return [(i, (centers[i % clusters] + 0.25 * rng.standard_normal(width)).tolist()) for i in range(n)]


def every_50th(docs):
    return docs.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")


def test_near_vectors_are_found_among_few(spark):
    docs = frame(spark, clustered(3000)).repartition(6)
    queries = every_50th(docs)
    exact = topk_cosine(queries, docs)
    found = approximate_topk(queries, docs, tables=8, bits=10)
    assert recall(found, exact).first()["recall"] >= 0.95
    met = candidate_pairs(queries, docs, 8, 10).count()
    assert met < 0.25 * 60 * 3000


def test_recall_on_the_given_vectors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").withColumnRenamed("vec_id", "doc_id")
    queries = every_50th(docs)
    found, exact = approximate_topk(queries, docs), topk_cosine(queries, docs)
    assert recall(found, exact).first()["recall"] >= 0.9
    # Found or not, a score is the exact cosine.
    all_scores = topk_cosine(queries, docs, k=500)
    off = found.join(all_scores.select("query_id", "doc_id", F.col("score").alias("exact_score")), ["query_id", "doc_id"])
    assert off.count() == found.count() and off.filter("abs(score - exact_score) > 2e-9").count() == 0


def test_queries_that_meet_too_few_are_searched_exactly(spark):
    docs = frame(spark, clustered(60, clusters=60))
    queries = frame(spark, [(1, (-np.array(clustered(1)[0][1])).tolist())], "query_id")
    exact = {tuple(r) for r in topk_cosine(queries, docs).collect()}
    assert approximate_topk(queries, docs, tables=1, bits=12, complete=False).count() < 5
    assert {tuple(r) for r in approximate_topk(queries, docs, tables=1, bits=12).collect()} == exact


def test_copies_fill_no_bucket(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000, [1.0, 2.0, 3.1]), (1001, [-1.0, 0.0, 0.0])]
    docs, queries = frame(spark, rows), frame(spark, [(7, [1.0, 2.0, 3.0])], "query_id")
    assert [r.doc_id for r in approximate_topk(queries, docs).orderBy("rank").collect()] == [0, 1, 2, 3, 4]
    assert approximate_topk(queries, docs, k=401).filter("doc_id = 1000").first()["rank"] == 401


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [1.0, None]), (6, [1.0, 0.0, 0.0]), (7, [0.0, 0.0])]
    docs = frame(spark, rows)
    queries = frame(spark, [(1, [1.0, 0.0]), (2, None), (3, [nan, 0.0]), (4, [0.0, 0.0])], "query_id")
    got = {(r.query_id, r.doc_id): (r.score, r["rank"]) for r in approximate_topk(queries, docs).collect()}
    assert got[1, 1] == (1.0, 1) and got[1, 7] == (0.0, 2)
    assert {q for q, _ in got} == {1, 4} and {d for _, d in got} == {1, 7}
    none = frame(spark, [])
    assert approximate_topk(queries, none).count() == 0
    assert approximate_topk(frame(spark, [], "query_id"), docs).count() == 0
    assert recall(approximate_topk(queries, none), topk_cosine(queries, none)).first()["recall"] is None


def ranked(df):
    return sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_only_the_best_leave_a_bucket_and_parts_change_nothing(spark):
    """Near vectors share their buckets; pairs used to leave them all, with both vectors."""
    docs = frame(spark, clustered(2000, clusters=2)).repartition(4)
    queries = every_50th(docs)
    met = candidate_pairs(queries, docs).count()
    rows = [t.withColumn("_row", F.monotonically_increasing_id()).localCheckpoint() for t in (queries, docs)]
    left = nearest._met_best(*rows, 3, nearest.TABLES, nearest.BITS, nearest.SEED, nearest.BLOCK_BYTES)
    assert left.count() <= 40 * 3 * nearest.TABLES * (nearest.BITS + 1) < met / 5
    assert left.select("query_id", "doc_id").exceptAll(candidate_pairs(queries, docs)).count() == 0
    whole = ranked(approximate_topk(queries, docs))
    assert len(whole) == 200
    assert ranked(approximate_topk(queries, docs, block_bytes=24 * 8 * 50)) == whole


def test_repeated_ids_and_null_ids(spark):
    rows = [(1, [1.0, 0.1]), (1, [1.0, 0.1]), (1, [-1.0, 0.1]), (2, [1.0, 0.2]), (None, [1.0, 0.3])]
    queries = frame(spark, [(7, [1.0, 0.0])] * 2, "query_id")
    got = ranked(approximate_topk(queries, frame(spark, rows), k=6))
    # Each row of the query meets each row of an id that any row of it meets.
    assert [(r, d) for _, r, d, _ in got] == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2)]


@pytest.mark.parametrize("k", [1, 5, 300])
def test_best_rows_equal_a_full_sort(monkeypatch, k):
    monkeypatch.setattr(nearest, "QUERY_SLICE", 16)
    monkeypatch.setattr(nearest, "DOC_SLICE", 64)
    rng = np.random.default_rng(5)
    queries, docs = rng.integers(-2, 3, (40, 3)).astype(float), rng.integers(-2, 3, (700, 3)).astype(float)
    scores = np.round(queries @ docs.T, 9)
    expected = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    asked, found, values = (np.concatenate(c) for c in zip(*nearest._best_rows(queries, docs, k)))
    assert (asked == np.repeat(np.arange(40), k)).all() and (found == expected.ravel()).all()
    assert (values == np.take_along_axis(scores, expected, 1).ravel()).all()


def test_planes_are_the_same_everywhere():
    assert (hash_planes(5, 2, 3) == hash_planes(5, 2, 3)).all() and set(hash_planes(64).ravel()) == {-1, 1}


@pytest.mark.parametrize("bits", [1, 5])
def test_a_bucket_join_broadcasts_no_vectors(spark, bits):
    docs = frame(spark, clustered(100))
    plan = candidate_pairs(every_50th(docs), docs, 2, bits)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "Join Cross" not in plan

"""Toxicity: the index against all cosines, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents  # noqa: F401
from tickloom.llm import toxicity
from tickloom.llm.block_max import BlockMaxIndex, unit
from tickloom.llm.queries import op13_toxicity
from tickloom.llm.toxicity import document_counts, fitted_steps, learn_toxicity, score_toxicity

BAD = ["vile", "scoundrel", "rotter"]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(0, 70), st.sampled_from([1, 3, 64]))
def test_nearest_are_those_of_all_cosines(seed, k, n, block):
    rng = random.Random(seed)
    n_terms = 6

    def vector():
        terms = sorted(rng.sample(range(n_terms), rng.randint(1, 4)))
        return terms, [rng.choice([1.0, 1.0, 2.5, rng.random() + 0.1]) for _ in terms]

    vectors = [vector() for _ in range(n)]
    whole = np.zeros((n, n_terms))
    for row, (terms, weights) in zip(whole, vectors):
        row[terms] = unit(weights)
    index = BlockMaxIndex(vectors, n_terms, block)
    for _ in range(5):
        terms, weights = vector()
        query = np.zeros(n_terms)
        query[terms] = unit(weights)
        cosines = np.round(whole @ query, 12)
        order = [i for i in np.lexsort((np.arange(n), -cosines)) if cosines[i] > 0][:k]
        found, values = index.nearest(terms, weights, k)
        assert np.allclose(values, cosines[order], atol=2e-12)
        assert all(cosines[i] == pytest.approx(v, abs=2e-12) for i, v in zip(found, values))
        assert len(set(found.tolist())) == len(order)


def test_steps_do_not_fall_and_keep_the_share():
    rng = np.random.default_rng(1)
    values, weights = np.round(rng.random(300), 2), rng.random(300)
    labels = (rng.random(300) < values).astype(int)
    starts, shares = fitted_steps(values, labels, weights)
    assert (np.diff(starts) > 0).all() and (np.diff(shares) > 0).all()
    fitted = shares[np.searchsorted(starts, values, "right") - 1]
    assert (fitted * weights).sum() == pytest.approx((labels * weights).sum())
    # No other step function that does not fall is nearer: the pools' means are least squares.
    grid = np.clip(values, 0, 1)
    assert (weights * (fitted - labels) ** 2).sum() <= (weights * (grid - labels) ** 2).sum()


def corpus(n, seed=1):
    """Rows, and toxic flags: bad words in every fourth document, none in the others."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("ala", "emo", "iru", "oda", "unt", "yst", "ark", "elo")]
    rows, flags = [], {}
    for i in range(n):
        flags[i] = int(i % 4 == 0)
        text = rng.choices(words, k=rng.randint(20, 120))
        for bad in rng.sample(BAD, 2) if flags[i] else []:
            text.insert(rng.randrange(len(text)), bad)
        rows.append((i, " ".join(text).capitalize()))
    return rows, flags


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def labels_of(spark, flags):
    return spark.createDataFrame([(i, 1, f) for i, f in flags.items()], "doc_id long, quality int, toxic int")


def scored(docs, labels, **options):
    rows = score_toxicity(docs, learn_toxicity(docs, labels, **options)).collect()
    return {r["doc"]["doc_id"]: r for r in rows}, len(rows)


def test_held_out_documents_are_told_apart(spark, documents):
    rows, flags = corpus(800)
    held = {i for i in flags if is_held_out(i)}
    # Labels of held-out rows turned round must not matter; nor must rows that the labels lack.
    told = {i: 1 - f if i in held else f for i, f in flags.items() if i % 5}
    got, n = scored(documents(*rows, extra=True), labels_of(spark, told))
    assert n == len(rows)
    assert np.mean([got[i]["predicted"] == flags[i] for i in held]) > 0.98
    assert np.mean([got[i]["predicted"] == flags[i] for i in flags]) > 0.98
    bad = next(i for i in held if flags[i])
    assert set(got[bad]["words"]) >= set(rows[bad][1].lower().split()) & set(BAD)
    assert got[bad]["evidence"] and all(not is_held_out(e["example"]) for e in got[bad]["evidence"])
    assert [e["similarity"] for e in got[bad]["evidence"]] == sorted((e["similarity"] for e in got[bad]["evidence"]), reverse=True)


def test_a_bounded_sample_of_a_hot_text_and_near_copies(spark, documents):
    rows, flags = corpus(600)
    rows += [(1000 + i, rows[3][1]) for i in range(300)]
    rows += [(2000 + i, rows[4][1] + f" end{i}") for i in range(60)]
    flags |= {1000 + i: 0 for i in range(300)} | {2000 + i: 1 for i in range(60)}
    got, n = scored(documents(*rows), labels_of(spark, flags), most=80)
    assert n == len(rows)
    assert np.mean([got[i]["predicted"] == flags[i] for i in flags]) > 0.95


def test_odd_texts_and_labels(spark, documents):
    rows, flags = corpus(400)
    labels = labels_of(spark, flags).union(spark.createDataFrame([(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int"))
    odd = [(900, None), (901, ""), (902, "1234 !?"), (None, "a vile scoundrel"), (903, "VILE, rotter! " + "bala " * 40_000),
           (7, rows[7][1]), (7, "vile rotter")]
    docs = documents(*rows, *odd)
    found = [r for r in score_toxicity(docs, learn_toxicity(docs, labels)).collect()]
    by_text = {r["doc"]["text"]: r for r in found}
    assert len(found) == len(rows) + len(odd)
    assert by_text[None]["score"] == by_text[""]["score"] == by_text["1234 !?"]["score"] < 0.05
    assert by_text["a vile scoundrel"]["predicted"] == by_text["vile rotter"]["predicted"] == by_text[odd[4][1]]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_without_labels_or_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows, flags = corpus(40)
    got, _ = scored(documents(*rows), none)
    assert {r["score"] for r in got.values()} == {0.0}
    got, _ = scored(documents(*rows), labels_of(spark, {i: 1 for i in flags}))
    assert {r["score"] for r in got.values()} == {1.0}
    empty = documents()
    assert score_toxicity(empty, learn_toxicity(empty, none)).collect() == []


def test_frequencies_are_counted_over_all_documents(spark, documents):
    docs = documents((1, "Vile vile x"), (2, None), (3, "a rotter, VILE"), (4, "évile"))
    assert document_counts(docs.repartition(3), ["vile", "rotter", "none"]) == (4, {"vile": 2, "rotter": 1})


def test_near_copies_of_an_example_go():
    row = [{"toxic": 1, "place": 1, "bands": [1, 2]}, {"toxic": 1, "place": 2, "bands": [2, 3]},
           {"toxic": 1, "place": 3, "bands": [3, 4]}, {"toxic": 0, "place": 4, "bands": [1]}, {"toxic": 0, "place": 5, "bands": []}]
    assert toxicity._independent(row) == [(0, 4), (0, 5), (1, 1)]


def test_the_query_finds_toxic_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = {}
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        labels[r["doc_id"]] = max(labels.get(r["doc_id"], 0), r["toxic"])
    got = op13_toxicity(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    told = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in got)
    assert np.mean([p for p, y in told if y]) > 0.8 and np.mean([p for p, y in told if not y]) < 0.03

"""Whitening against numpy's own eigenvectors, and the rank-one updates it is made of."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import SMALL
from tickloom.llm.queries import op12_whitening
from tickloom.llm.spectrum import Spectrum, rank_one, secular_roots
from tickloom.llm.whitening import fit_whitening, whiten_embeddings


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)


def expected(rows, components=4):
    """{vec_id: (n, deviation, whitened up to sign)} and the explained shares."""
    x = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), float)
    mean = fit.mean(axis=0)
    values, vectors = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    order = np.argsort(-values)[:components]
    sums = [int(s) for s in fit.sum(axis=0)]
    out = {
        i: (len(fit), sum((len(fit) * a - s) ** 2 for a, s in zip(v, sums)),
            (np.array(v) - mean) @ vectors[:, order] / np.sqrt(values[order]))
        for i, v in x.items()
    }
    return out, values[order] / values.sum()


def check(got, rows, components=4):
    want, explained = expected(rows, components)
    assert len(got) == len(rows) * len(explained)
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        n, deviation, whitened = want[r["vec_id"]]
        value = whitened[r["component"] - 1]
        sign = signs.setdefault(r["component"], math.copysign(1, value * r["whitened"]))
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["whitened"] == pytest.approx(sign * value, abs=1e-8)
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert r["identity_error"] < 1e-9


def test_whitened_vectors_are_those_of_the_whole_covariance(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(7) * np.arange(1, 8) + 3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(50)]
    check(whiten_embeddings(frame(spark, rows, 40)).collect(), rows)


def test_the_query_holds_over_the_whole_table(spark):
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(op12_whitening(spark, SMALL).collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (None, [3.0, -0.0]), (4, [-1e-9, 2.0])]
    odd = [(5, None), (6, []), (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 2.0, 3.0])]
    df = frame(spark, good + odd)
    for name in ("x", "n", "component", "width", "part", "whitened"):
        df = df.selectExpr("*", f"'y' AS {name}")
    got = whiten_embeddings(df).collect()
    assert sorted(str(r["vec_id"]) for r in got if r["component"] == 1) == ["1", "2", "2", "4", "None"]
    assert {r["n"] for r in got} == {4} and {r["component"] for r in got} == {1, 2}
    x = {(0, 256), (256, 128), (768, 0), (-1, 512)}
    s = [sum(v) for v in zip(*x)]
    assert {r["deviation"] for r in got} == {sum((4 * a - b) ** 2 for a, b in zip(v, s)) for v in x}


def test_nothing_to_whiten(spark):
    assert whiten_embeddings(frame(spark, [])).collect() == []
    assert whiten_embeddings(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    # Two vectors vary in one direction only.
    got = whiten_embeddings(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()
    assert sorted((r["component"], abs(round(r["whitened"], 9))) for r in got) == [(1, 1.0), (1, 1.0)]


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(1, [1e7, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 7.0])]
    got = {(r["vec_id"]): r["deviation"] for r in whiten_embeddings(frame(spark, rows), 1).collect()}
    assert got[1] is None or got[1] < 2**63
    want = expected(rows, 1)[0]
    assert all(got[i] == (want[i][1] if want[i][1] < 2**63 else None) for i in got)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6), st.sampled_from(["normal", "few", "far", "same"]))
def test_secular_roots_and_rank_one_updates(width, seed, form):
    rng = np.random.default_rng(seed)
    a = {"normal": rng.standard_normal((20, width)), "few": rng.integers(-1, 2, (20, width)).astype(float),
         "far": rng.standard_normal((20, width)) * 10.0 ** rng.integers(-9, 9, (20, width)),
         "same": np.ones((20, width))}[form]
    values, vectors, whole = np.zeros(width), np.eye(width), np.zeros((width, width))
    for v in a:
        values, vectors = rank_one(values, vectors, v)
        whole += np.outer(v, v)
        size = max(np.abs(whole).max(), 1e-300)
        assert np.abs(vectors @ np.diag(values) @ vectors.T - whole).max() <= 1e-12 * size
        assert np.abs(vectors.T @ vectors - np.eye(width)).max() <= 1e-12


def test_roots_lie_between_the_poles():
    d, z = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-7, 0.5, 2.0, 1e-3])
    roots, apart = secular_roots(d, z)
    assert (roots >= d).all() and (roots[:-1] <= d[1:]).all()
    terms = z * z / apart
    assert (np.abs(terms.sum(axis=1) - 1) <= 1e-14 * np.abs(terms).sum(axis=1)).all()


def test_merged_spectra_are_those_of_all_vectors():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (90, 6))
    parts = []
    for own in (x[:1], x[1:40], x[40:]):
        s = Spectrum(6)
        for v in own:
            s.add(v)
        parts.append(s)
    first, *others = parts
    for other in others:
        first.merge(other)
    centred = x - x.mean(axis=0)
    assert first.n == 90 and (first.sums == x.sum(axis=0)).all()
    assert np.allclose(first.vectors @ np.diag(first.values) @ first.vectors.T, centred.T @ centred, rtol=1e-10, atol=1e-6)


def test_spectra_merge_in_rounds(spark, monkeypatch):
    from tickloom.llm import whitening

    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (60, 4))
    fit = spark.createDataFrame([([int(c) for c in v],) for v in x], "x array<long>").repartition(9)
    model = fit_whitening(fit, 4, 4)
    centred = x - x.mean(axis=0)
    assert model.n == 60
    assert np.allclose(sorted(model.values), np.linalg.eigvalsh(centred.T @ centred / 60), rtol=1e-10)

import random

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import documents  # noqa: F401
from tickloom.llm import ngram_join
from tickloom.llm.common import python_batches, store
from tickloom.llm.components import components
from tickloom.llm.ngram_join import block_keys, shingle_set, similar_documents


def shingles(text):
    words = [w for w in (text or "").translate(str.maketrans("ABCXYZ", "abcxyz")).split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 90 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, groups=6, each=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        size = rng.choice([5, 12, 30, 60, 150, 400])
        base = [f"w{rng.randrange(60)}" for _ in range(size)]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randrange(4)):  # chains: copies of copies
                words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
            if rng.random() < 0.3:
                base = words
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return [(10 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, documents, seed):
    rows = near_copies(seed) + [(5, None), (6, ""), (7, "  "), (8, "A b"), (9, "a B"), (11, "a"), (12, "X")]
    rows += [(9000 + i, "same text over and over again in all of these copies") for i in range(30)]
    got = similar_documents(documents(*rows, extra=True)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark, documents):
    docs = documents((3, "a b c d"), (3, "a b c d"), (2, "a b c d"), (None, "a b c d"), (4, "a b c e"))
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in similar_documents(docs).collect())
    assert got == [(0, 0), (2, 2), (3, 2), (3, 2), (4, 4)]
    assert similar_documents(documents((1, "a")).limit(0)).count() == 0


def test_alike_sets_share_a_key():
    """Whatever differs within the bound, some block stays the same."""
    rng = np.random.default_rng(3)
    for n in (10, 19, 20, 57, 200, 1000, 5000):
        for _ in range(60):
            union = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            differ = rng.permutation(len(union))[: len(union) // 10]
            cut = rng.integers(0, len(differ) + 1)
            a, b = np.delete(union, differ[:cut]), np.delete(union, differ[cut:])
            assert np.intersect1d(block_keys(a), block_keys(b)).size or (a.size == b.size and (a == b).all())


def test_short_texts_are_one_shingle():
    def hash_of(word):
        return len(word)

    assert len(shingle_set(b"a", hash_of)) == len(shingle_set(b"a bb", hash_of)) == 1
    assert len(shingle_set(b"a bb ccc dddd", hash_of)) == 2
    assert len(shingle_set(None, hash_of)) == 0


def test_python_tasks_get_and_give_small_batches(spark, documents, monkeypatch):
    key, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    def noted(df, name):
        sizes.setdefault(name, set()).add(df.sparkSession.conf.get(key))
        return store(df, name)

    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "store", noted)
    similar_documents(documents(*near_copies(3))).count()
    for name in ("join-sketches", "join-keys", "join-texts", "join-links"):
        assert str(ngram_join.BATCH_BYTES) in sizes[name]
    assert sizes["join-texts"] == sizes["join-links"] == {str(ngram_join.BATCH_BYTES)}
    assert spark.conf.get(key) == before

    def lengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 1000) AS text").mapInArrow(lengths, "n long")
    with python_batches(spark, 100_000):
        assert max(r.n for r in rows.collect()) < 200_000


def test_what_has_met_is_given_in_parts(monkeypatch):
    keys = np.arange(1000, dtype="<u8").view(np.uint8).reshape(-1, 8)[:, : ngram_join.KEY_BYTES].tobytes()
    column = [pa.array([7, 7]), pa.array([np.array([i], "<i8").tobytes() for i in (1, 2)])]
    column += [pa.array([np.array([1000], "<u4").tobytes()] * 2), pa.array([keys] * 2)]
    dealt = pa.RecordBatch.from_arrays(column, ["bucket", "sets", "counts", "keys"])
    # Of keys with the same holders one is given; in parts, each is.
    monkeypatch.setattr(ngram_join, "AT_ONCE", 1000)
    whole = pa.Table.from_batches(ngram_join._meeting([dealt])).to_pylist()
    monkeypatch.setattr(ngram_join, "MET_ROWS", 64)
    parts = list(ngram_join._meeting([dealt]))
    assert max(p.num_rows for p in parts) <= 64
    assert pa.Table.from_batches(parts).to_pylist() == whole and len(whole) == 2000


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 200), (None, 3)]
    df = spark.createDataFrame(edges + edges[:5], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)} | {200: 200}
    assert components(df.limit(0)).count() == 0


def test_sketches_are_never_further_apart_than_sets():
    rng = np.random.default_rng(5)
    for likeness in (ngram_join.OP8, ngram_join.Likeness(5, (4, 5))):
        for n in (1, 40, 900, 1500, 6000):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            b = np.unique(np.concatenate((a[n // 8 :], rng.integers(0, 1 << 63, n // 6, np.uint64))))
            x, y = (ngram_join.parity_sketch(s, likeness) for s in (a, b))
            short = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(s.reshape(-1, short), axis=0) for s in (x, y))
            apart = len(np.setxor1d(a, b))
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= apart
            fold = ngram_join._folded(x) ^ ngram_join._folded(y)
            assert int(np.bitwise_count(fold.view(np.uint64)).sum()) <= apart


@pytest.mark.parametrize("size", [300, 900, 3000])
def test_families_below_the_threshold_are_not_verified_pairwise(spark, documents, monkeypatch, size):
    """Any two edits of a text have a likeness of about 0.7, where 0.8 are asked for; one has a near copy."""
    rng = random.Random(size)
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    rows = []
    for k in range(40):
        words = list(base)
        for place in rng.sample(range(size // 5), size // 50):
            words[5 * place] = f"e{k}x{place}"
        rows.append((k, " ".join(words)))
    twin = rows[7][1].split()
    twin[1] = "twin"
    rows.append((99, " ".join(twin)))
    asked = []

    def noted(df, name):
        kept = store(df, name)
        if name == "join-pairs":
            asked.append(kept.count())
        return kept

    monkeypatch.setattr(ngram_join, "store", noted)
    got = {r.doc_id: r.component_id for r in similar_documents(documents(*rows), 5, (4, 5)).collect()}
    assert got == {k: k for k in range(40)} | {99: 7}
    assert sum(asked) <= 20

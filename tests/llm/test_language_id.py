import zlib

import numpy as np
import pytest

from llm_fixtures import SMALL, documents  # noqa: F401
from tickloom.llm.common import table
from tickloom.llm.language_id import (
    BiGru,
    held_out,
    identify_languages,
    learn_languages,
    training_sample,
)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = BiGru(3, 4, rng)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data, labels = rng.integers(97, 101, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)

    def loss():
        return -np.log(net.probabilities(data)[:, np.arange(5), labels]).mean()

    for name, grad in net.gradients(data, labels).items():
        w = net.weights[name]
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            at = (int(data[0, 0]), at[1]) if name.startswith("in_") else at
            old = w[at]
            w[at] = old + 1e-3
            up = loss()
            w[at] = old - 1e-3
            down = loss()
            w[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-3, abs=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    return learn_languages(training_sample(table(spark, SMALL.replace("0.001", "0.01"), "documents")))


def test_held_out_accuracy(spark, model):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = identify_languages(docs, model).select(
        "doc.doc_id", "doc.lang", "lang_pred", "score", "positions"
    ).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 < r.score <= 1 and max(r.positions, key=r.positions.get) is not None for r in rows)


def test_sample_leaves_out_held_and_unlabelled_documents(spark, documents):
    rows = [(i, f"text {i}", "ab"[i % 2] if i % 5 else None, None) for i in range(200)] + [(900, None, "a", None)]
    docs = documents(*rows, (None, "no id", "c", None))
    assert {r.doc_id for r in docs.where(held_out(docs["doc_id"])).collect()} == {
        i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2
    }
    sample = training_sample(docs)
    allowed = {f"text {i}".encode() for i in range(200) if i % 5 and zlib.crc32(str(i).encode()) % 4 != 2}
    assert {t for _, t in sample} == allowed | {b"no id"}
    assert len(training_sample(docs, per_language=3)) == 7 and training_sample(docs, chars=2)[0][1] == b"te"


def test_sample_is_bounded_and_not_filled_by_missing_or_repeated_ids(spark, documents, monkeypatch):
    rows = [(None, f"no id {i}", "a", None) for i in range(400)] + [(i, f"text {i}", "a", None) for i in range(400)]
    rows += [(i, "copy", "a", None) for i in range(1000, 1400)] + [(8, f"same id {i}", "b", None) for i in range(400)]
    docs, collected = documents(*rows), []
    assert docs.where(held_out(docs["doc_id"]) & (docs["doc_id"] == 8)).count() == 0
    kind = type(docs)
    collect = kind.collect

    def counting(df):
        found = collect(df)
        collected.append(len(found))
        return found

    monkeypatch.setattr(kind, "collect", counting)
    sample = training_sample(docs, per_language=100)
    assert collected and max(collected) <= 200
    assert len(sample) == len(set(sample)) == 200 and sum(lang == "a" for lang, _ in sample) == 100
    without = sum(t.startswith(b"no id") for _, t in sample)
    assert 30 < without < 85  # 400 of about 700 texts of the language
    assert sample == training_sample(docs.repartition(7), per_language=100)


def test_texts_without_letters_and_other_columns(spark, documents, model):
    long_word = "the" * 50_000
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "123 !? 45", "en", "s"), (4, "漢字", "en", "s"),
            (5, "the of and with that", "de", "s"), (5, "the of and with that", None, "t"), (6, long_word, None, None)]
    got = identify_languages(documents(*rows, extra=True), model, ["doc_id"]).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred in model.languages
    assert got[4].lang_pred == "en" and (got[4].score, got[4].positions) == (got[5].score, got[5].positions)
    assert sum(got[6].positions.values()) == len(long_word)


def test_nothing_learned(spark, documents):
    empty = learn_languages(training_sample(documents((1, "text"))))
    assert [(r.lang_pred, r.score) for r in identify_languages(documents((1, "text")), empty).collect()] == [("und", 0.0)]
    assert identify_languages(documents((1, "a")).limit(0), empty).count() == 0

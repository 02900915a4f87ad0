from collections import defaultdict

import pytest

from llm_fixtures import documents  # noqa: F401
from tickloom.llm.mixing import mix_sources, source_targets


def test_targets_by_hand(spark):
    sizes = [("a", 100), ("b", 10), ("c", 100), ("d", 100), (None, 0)]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    # Weights 1, 2, 3, 1, 2: b stops at 30, the other 280 words go 1 : 3 : 1.
    assert got == pytest.approx({"a": 56.0, "b": 30.0, "c": 168.0, "d": 56.0, None: 0.0})


def rows_of(n):
    return [(i, "w " * (1 + i % 7), None, f"s{i % 5}" if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("step_rows", [50_000, 1])
def test_sources_come_to_their_targets(spark, documents, step_rows):
    got = mix_sources(documents(*rows_of(400), (999, None), (1000, ""), extra=True), step_rows=step_rows).collect()
    assert len(got) == 402
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.epochs * r.size <= r.taken <= (r.epochs + 1) * r.size
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert r.source_size == sum(1 + i % 7 for i in range(400) if (f"s{i % 5}" if i % 5 else None) == r.source)
    assert {s: int(t) for s, t in target.items()} == dict(taken)
    assert sum(target.values()) == pytest.approx(sum(size.values()))


def test_reruns_agree_and_quality_counts(spark, documents):
    docs = documents(*[(i, "w " * 10, None, "ab"[i % 2]) for i in range(2000)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 2000, 2)] + [(None, 1)], "doc_id long, quality int")
    first = {r.doc_id: r.taken for r in mix_sources(docs, labels).collect()}
    assert first == {r.doc_id: r.taken for r in mix_sources(docs.repartition(7), labels).collect()}
    # Source a (weight 1 of 3) is drawn from: good documents four times as likely as bad ones.
    good, bad = (sum(first[i] > 0 for i in range(k, 2000, 4)) for k in (0, 2))
    assert good > 1.5 * bad


def test_repeated_rows_and_no_rows(spark, documents):
    got = mix_sources(documents((1, "a b", None, "s"), (1, "a b", None, "s"), (2, "c", None, "t"))).collect()
    assert len(got) == 3 and {r.source_size for r in got} == {4, 1}
    assert mix_sources(documents((1, "a")).limit(0)).count() == 0

import random

import pytest

import corpus_pipeline
from llm_fixtures import SMALL, documents  # noqa: F401
from tickloom.llm.decontamination import words_of

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_are_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names[0].startswith("language") and names[-1].startswith("mixing") and len(names) == 5


def test_run_on_small_tables(spark):
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert 100 < len(rows) <= 200 and len({r.doc_id for r in rows}) == len(rows)
    taken, target = {}, {}
    for r in rows:
        assert 0 < r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert taken == {s: int(t) for s, t in target.items()}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Own texts with a known fate, over the benchmark and labels of the small tables."""
    rng = random.Random(9)
    vocabulary = {
        "en": "the of and that with this from they have were been their which would".split(),
        "de": "der und nicht eine werden sich auch nach bei einer über können durch".split(),
    }

    def prose(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(n))

    clean = [(i, prose(lang := "ende"[i % 2 * 2 :][:2], 120), lang) for i in range(60)]
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    rows = clean + [
        (100, clean[3][1], "de"), (101, clean[4][1] + " end", "en"), (102, item + " " + prose("en", 20), "en"),
        (103, "12 34 !!", None), (104, None, "en"), (105, prose("en", 60) + " mail me@here.example.org now", "en"),
        (105, "a repeated row with the id of another text altogether", None),
    ]
    folder = str(tmp_path_factory.mktemp("planted"))
    full = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(full, DOCUMENT).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    assert len(words_of(item.encode())) >= 13
    return folder, {i for i, *_ in clean}


def test_each_stage_does_its_part_and_keeps_clean_documents(spark, planted):
    folder, clean = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    language, copies, bench, pii = kept
    assert clean <= pii
    assert {103, 104}.isdisjoint(language) and {100, 101, 102, 105} <= language
    assert {100, 101}.isdisjoint(copies) and 102 in copies
    assert 102 not in bench and bench == pii
    texts = sorted((r.text, r.n_chars) for r in docs.collect() if r.doc_id == 105)
    assert len(texts) == 2 and texts[0][0].startswith("a repeated") and texts[1][0].endswith("mail [EMAIL] now")
    assert all(n == len(t) for t, n in texts)


def test_near_copies_are_those_of_five_words_and_four_fifths(spark, documents):
    """Against brute force, with copies that 3 words and 0.9 would leave in."""
    rng = random.Random(12)
    rows = []
    for group in range(25):
        size = rng.choice([4, 9, 30, 60, 100, 100, 150, 400])
        base = [f"g{group}w{i}" for i in range(size)]
        rows.append(base)
        for changes in (1, 2, 3, 4):
            words = list(base)
            for place in rng.sample(range(size), changes):
                words[place] = f"x{rng.randrange(10**9)}"
            rows.append(words)
        rows.append(base[: size - size // 6])
    rng.shuffle(rows)

    def sets(words, k):
        return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))}

    def firsts(k, least):
        found, label = [sets(w, k) for w in rows], list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                if len(found[a] & found[b]) >= least * len(found[a] | found[b]) - 1e-9 and label[a] != label[b]:
                    low, high = sorted((label[a], label[b]))
                    label = [low if x == high else x for x in label]
        return set(label)

    docs = documents(*[(i, " ".join(w)) for i, w in enumerate(rows)])
    want = firsts(5, 0.8)
    assert len(firsts(3, 0.9) - want) > 10
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == want


def test_rows_are_known_by_id_and_text(spark, documents):
    one, two, three = ("".join(f"{w}{i} " for i in range(40)) for w in ("a", "b", "c"))
    docs = documents(
        (1, one), (1, two), (1, one), (None, two), (None, three), (None, three), (5, three), (None, None), (None, None),
        (6, None), (7, ""), (8, "- -"), (9, one + "more"), extra=True,
    )
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()), key=str)
    want = [(1, one), (1, two), (5, three), (None, None), (6, None), (7, ""), (8, "- -")]
    assert got == sorted(want, key=str)


def test_what_is_unclear_depends_on_the_number_of_languages():
    assert corpus_pipeline.least_score(4) == pytest.approx(0.3)
    assert corpus_pipeline.least_score(1) == 1 and 0.5 < corpus_pipeline.least_score(2) < 0.54
    assert 0.01 < corpus_pipeline.least_score(100) < 0.1


def test_stages_take_empty_tables_null_sources_and_other_columns(spark, documents, planted):
    folder, _ = planted
    empty = documents()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
    text = "the of and that with this from they have were been their which would " * 3
    docs = documents((1, text, "en", None), (2, None, None, None), (None, " ".join(reversed(text.split()[:9])) + " and further words", "en", "s"), extra=True)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, folder)
        assert "key" in docs.columns and "doc" in docs.columns
    assert {r.doc_id for r in docs.collect()} == {1, 2, None}
    assert {r.doc_id for r in corpus_pipeline.mix(spark, docs, folder).collect()} <= {1, None}

from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401
from tickloom.llm.decontamination import _blocks, find_contamination, without_spans, words_of

PHRASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def brute(text, items, window=13):
    words = words_of((text or "").encode())
    hit, found = set(), set()
    for item_id, item in items:
        own = words_of((item or "").encode())
        n = min(len(own), window)
        for s in range(len(own) - n + 1 if own and item_id is not None else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[s : s + n]:
                    hit.update(range(p, p + n))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def test_hits_equal_brute_force_for_any_shard_and_block(spark, documents):
    items = [(10, PHRASE), (2, "Short Item"), (3, None), (4, "!?"), (None, "alpha beta"), (5, "short item"), (7, "é1 é1")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        None, "", "?!", PHRASE.upper(), f"x {PHRASE} y " * 3, "short, item; short item alpha beta",
        " ".join(PHRASE.split()[:12]), "É1 é1 é1 é1 x", ("noise " * 400) + PHRASE + (" noise" * 400),
        "short item", "short item",
    ]
    docs = documents(*enumerate(texts), (None, PHRASE), extra=True)
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    for shard, block in ((1_000_000, 200_000), (50, 200_000), (1_000_000, 3)):
        rows = find_contamination(docs, bench, ["doc_id"], shard_words=shard, block_words=block).collect()
        got = {r.doc.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows if r.doc.doc_id is not None}
        assert got == want
        assert len(rows) == len(texts) + 1
        flags = {r.doc.doc_id: r.contaminated for r in rows}
        assert flags[3] and not flags[0] and not flags[8] and flags[9]


def test_items_of_many_blocks_are_numbered_once(spark):
    items = [(i, f"Alpha-{i} beta é{i}") for i in range(50)] + [(3, "Alpha-3 beta é3")] * 20 + [(None, "x"), (60, None)]
    blocks, count = _blocks(spark.createDataFrame(items, "item_id long, text string"), 20)
    rows = blocks.collect()
    assert count == 10 and len(rows) == 50 and {r.block for r in rows} <= set(range(count))
    assert all(r.n_words == len(words_of(bytes(r.text))) == 4 for r in rows)


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = find_contamination(documents((1, "a b")), bench).collect()
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows] == [(2, 0, [], False)]
    assert find_contamination(documents((1, "a")).limit(0), bench).count() == 0


def test_spans_cut_the_passage(spark, documents):
    bench = spark.createDataFrame([(1, PHRASE)], "item_id long, text string")
    found = find_contamination(documents((1, f"é before {PHRASE}. after"), (2, "clean")), bench)
    cut = found.select("doc.doc_id", without_spans(F.col("doc.text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in cut.collect()} == {1: "é before . after", 2: "clean"}

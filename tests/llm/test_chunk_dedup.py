import random

import numpy as np

from llm_fixtures import SMALL, documents  # noqa: F401
from tickloom.llm import chunk_dedup
from tickloom.llm.chunk_dedup import LONGEST, REACH, chunk_ends, cut_repeats, gear_hashes, repeated_spans


def prose(rng, words):
    return " ".join("".join(rng.choices("abcdefghilmnoprstué", k=rng.randrange(2, 9))) for _ in range(words))


def as_bytes(text):
    return np.frombuffer(text.encode(), np.uint8)


def test_gear_hash_is_the_rolling_one():
    from tickloom.llm.chunk_dedup import _GEAR

    data, h = as_bytes(prose(random.Random(1), 50)), 0
    for byte, got in zip(data, gear_hashes(data), strict=True):
        h = ((h << 1) + int(_GEAR[byte])) & 0xFFFFFFFF
        assert int(got) == h


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(2)
    text = prose(rng, 2000)
    ends = chunk_ends(as_bytes(text))
    sizes = np.diff(np.concatenate(([0], ends)))
    assert ends[-1] == len(text.encode()) and sizes.max() <= LONGEST and np.median(sizes) > REACH
    assert len(text.encode()) / len(ends) < 60
    for end in ends[:-1]:
        text.encode()[:end].decode()  # never inside of a character
    moved = set((chunk_ends(as_bytes("inserted " + text)) - 9).tolist())
    assert len(set(ends.tolist()) - moved) <= 3
    assert chunk_ends(as_bytes("")).size == 0
    same = chunk_ends(as_bytes("a" * 1000))  # only its first bytes have hashes of their own
    assert same[-1] == 1000 and len(same) <= 6 and np.diff(same).max() <= LONGEST


def test_passages_of_fifty_words_are_found_and_clean_texts_left_alone(spark, documents):
    rng = random.Random(3)
    rows, planted = [], {}
    passages = [prose(rng, 55) for _ in range(40)]
    for i in range(200):
        before, after = prose(rng, rng.randrange(5, 200)), prose(rng, rng.randrange(5, 200))
        if i % 2:
            rows.append((i, f"{before} {passages[i % 40]} {after}"))
            planted[i] = (len(before) + 1, len(before) + 1 + len(passages[i % 40]))
        else:
            rows.append((i, before + " shared short line of some words. " + after))
    spans = repeated_spans(documents(*rows, extra=True)).collect()
    later = {i for i in planted if any(j < i and j % 40 == i % 40 for j in planted)}
    assert {r.doc_id for r in spans} == later
    for r in spans:
        start, end = planted[r.doc_id]
        assert start <= r.start < r.end <= end
        assert r.first_doc_id < r.doc_id and r.first_doc_id % 40 == r.doc_id % 40
        text, first = dict(rows)[r.doc_id], dict(rows)[r.first_doc_id]
        assert text[r.start : r.start + 40] == first[r.first_start : r.first_start + 40]


def test_copies_nulls_repeats_and_cutting(spark, documents):
    rng = random.Random(4)
    long_text, short = prose(rng, 300), "tiny"
    docs = documents(
        (5, long_text), (5, long_text), (7, long_text), (9, None), (10, ""), (11, short), (12, short), (None, long_text),
        (13, prose(rng, 40) + " " + long_text),
    )
    spans = repeated_spans(docs)
    got = {r.doc_id: (r.start, r.end, r.first_doc_id) for r in spans.collect()}
    assert set(got) == {5, 7, 13} and {v[2] for v in got.values()} == {None}  # null comes first
    assert got[7][:2] == (0, len(long_text))
    cut = {r.doc_id: r.text for r in cut_repeats(docs, spans).collect()}
    assert cut[7] == "" and cut[None] == long_text and cut[11] == short and cut[9] is None
    assert long_text[100:900] not in cut[13]
    assert repeated_spans(docs.limit(0)).count() == 0
    assert repeated_spans(documents((1, "x" * 200_000))).count() <= 1


def test_windows_of_equal_passages_meet_and_runs_take_few():
    rng, powers = random.Random(5), chunk_dedup._Powers()
    for words in (50, 51, 80):
        for vocabulary in (2, 5, 5000):
            for _ in range(60):
                passage = " ".join(f"v{rng.randrange(vocabulary)}" for _ in range(words))
                found = []
                for _ in range(2):
                    text = f"{prose(rng, rng.randrange(90))} {passage}  {prose(rng, rng.randrange(90))}".encode()
                    at = text.index(passage.encode())
                    starts, ends = chunk_dedup.window_places(as_bytes(text.decode()), powers)
                    inside = (starts >= at) & (ends <= at + len(passage))
                    found.append({text[a:b] for a, b in zip(starts[inside], ends[inside], strict=True)})
                assert found[0] & found[1]
    assert len(chunk_dedup.window_places(as_bytes("a " * 10_000), powers)[0]) < 500
    assert len(chunk_dedup.window_places(as_bytes("a " * 49), powers)[0]) == 0


def test_all_passages_of_51_words_of_the_table_are_found(spark, documents):
    """Each in two documents of its own, between words that nothing else has."""
    rng = random.Random(6)
    texts = [r.text.split() for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect() if r.text]
    texts = [t for t in texts if len(t) >= 120 and len(set(t)) > len(t) / 3]
    rows, passages = [], {}
    for i in range(3000):
        text = texts[i % len(texts)]
        at = rng.randrange(len(text) - 51)
        # A word of its own in the middle keeps one passage from repeating another.
        passage = text[at : at + 51]
        passage[25] = f"own{i}"
        passages[3000 + i] = " ".join(passage)
        rows += [(j, f"{prose(rng, 30)} {passages[3000 + i]} {prose(rng, 30)}") for j in (i, 3000 + i)]
    spans = repeated_spans(documents(*rows)).where("doc_id >= 3000").collect()
    assert {r.doc_id for r in spans} == set(passages)
    text_of = dict(rows)
    for r in spans:
        part = text_of[r.doc_id][r.start : r.start + 40]
        assert text_of[r.first_doc_id][r.first_start :].startswith(part[: r.end - r.start])


def test_documents_are_known_by_id_and_text(spark, documents):
    rng = random.Random(7)
    for doc_id in (None, 7):
        shared, clean = prose(rng, 300), prose(rng, 300)
        texts = [f"{prose(rng, 40)} {shared}", f"{shared} {prose(rng, 60)}", clean]
        docs = documents(*[(doc_id, t) for t in texts], (doc_id, texts[0]), (1, ""), extra=True)
        spans = repeated_spans(docs)
        (span,) = spans.collect()
        assert span.doc_id == span.first_doc_id == doc_id and span.text_hash != span.first_text_hash
        cut = cut_repeats(docs, spans)
        assert cut.columns == docs.columns
        left = sorted(r.text for r in cut.collect())
        assert len(left) == 5 and clean in left and sum(len(shared) > len(t) > 0 for t in left) in (1, 2)
        # The kept place stays, the other one goes.
        assert any(shared in t for t in left) and not all(shared in t for t in left if t not in ("", clean))


def test_both_stretches_of_a_row_hold_the_same_text(spark, documents):
    rng = random.Random(8)
    x, y, z, w = (prose(rng, 120) for _ in range(4))
    texts = {1: f"{x} {y}", 2: f"{y} {z}", 3: f"{x} {y} {z}", 4: f"{z} {w} {y}", 5: f"{y} {y}", 6: f"{w} {x}"}
    docs = documents(*texts.items())
    spans = repeated_spans(docs)
    rows = spans.collect()
    for r in rows:
        first = texts[r.first_doc_id][r.first_start : r.first_start + r.end - r.start]
        assert texts[r.doc_id][r.start : r.end] == first and len(first) == r.end - r.start
    assert {(r.doc_id, r.first_doc_id) for r in rows} >= {(3, 1), (3, 2), (4, 2), (4, 1), (6, 4), (6, 1)}
    left = {r.doc_id: r.text for r in cut_repeats(docs, spans).collect()}
    assert left[1] == texts[1] and len(left[3]) < 150
    assert all(part not in left[i] for i in (3, 4, 6) for part in (x[100:-100], y[100:-100]))


def test_rows_of_the_table_hold_equal_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = repeated_spans(docs).collect()
    assert rows
    for r in rows:
        assert texts[r.doc_id][r.start : r.end] == texts[r.first_doc_id][r.first_start : r.first_start + r.end - r.start]

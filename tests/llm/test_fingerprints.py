import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401
from tickloom.llm.fingerprints import differing_paragraphs, fingerprint, fingerprint_edits, likeness


def brute_tree(text):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    sections = re.split(r"(?<=\n\n)(?!\n)", text)
    phrase = r"(?:(?!\S*[.!?]\s)\S+\s*){0,7}\S+\s*|\s+"
    tree = [[[sha(x) for x in re.findall(phrase, p)] for p in re.split(r"(?<=\n)", s)] for s in sections]
    root = sha("".join(sha("".join(sha("".join(p)) for p in s)) for s in tree))
    return root + ":" + "/".join(".".join("".join(d[:8] for d in p) for p in s) for s in tree)


TEXTS = [
    "", "a", "One two. Three four five six seven eight nine ten eleven.\nNew line\n\nNew section é\n", "  lead",
    "x\n\n\ny\n\nz", "\n", "w " * 40, "漢字 " * 20 + "\n" + "end.",
]


def test_tree_equals_brute_force(spark, documents):
    got = documents(*enumerate(TEXTS)).select("doc_id", fingerprint(F.col("text")).alias("f")).collect()
    assert {r.doc_id: r.f for r in got} == {i: brute_tree(t) for i, t in enumerate(TEXTS)}
    assert len({r.f for r in got}) == len(TEXTS)


@pytest.mark.parametrize("bucket_rows", [20_000, 1])
def test_edits_take_the_next_document(spark, documents, bucket_rows):
    rows = [(7 * i, TEXTS[i % len(TEXTS)] + " word" * (i % 9)) for i in range(60)] + [(10**15, None), (-5, "first")]
    got = fingerprint_edits(documents(*rows, extra=True), bucket_rows).collect()
    ordered = sorted(rows)
    assert len(got) == len(rows)
    for r in got:
        i = [k for k, _ in ordered].index(r.doc_id)
        text, following = ordered[i][1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        assert (r.n_chars, r.edited_text) == (len(text), edited)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == brute_tree(text) and r.edited_fingerprint == brute_tree(edited)
        assert 0 <= r.near_edited <= 1 and (text != edited or r.near_edited == 1.0)
        assert 0 <= r.near_next <= 1


def test_single_null_repeated_and_no_documents(spark, documents):
    one = fingerprint_edits(documents((1, "abcdefgh"))).collect()
    assert [(r.edited_text, r.near_next) for r in one] == [("abcdefab", 1.0)]
    rows = fingerprint_edits(documents((None, "null id text"), (3, "same"), (3, "same"), (4, None))).collect()
    assert sorted(r.edited_text for r in rows) == ["", "null id tsam", "sam", "sams"]
    assert fingerprint_edits(documents((1, "a")).limit(0)).count() == 0


def test_likeness_and_differing_branches(spark, documents):
    words = [f"word{i}" for i in range(160)]
    lines = [" ".join(words[i : i + 16]) + "\n" for i in range(0, 160, 16)]
    changed = list(lines)
    changed[3] = "now for something else\n"
    pairs = [("".join(lines), "".join(changed)), ("a b", "a b"), ("a", "b"), ("", "x"), ("s\n\nt", "s\n\nu")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    a, b = fingerprint(F.col("a")), fingerprint(F.col("b"))
    got = df.select("i", likeness(a, b).alias("l"), differing_paragraphs(a, b).alias("d")).orderBy("i").collect()
    assert got[0].l == pytest.approx(2 * 18 / 39) and [tuple(x) for x in got[0].d] == [(0, 3)]
    assert [r.l for r in got[1:4]] == [1.0, 0.0, 0.0] and got[1].d == []
    assert [tuple(x) for x in got[4].d] == [(1, 0)]

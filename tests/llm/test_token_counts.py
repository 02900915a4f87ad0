import random

import pytest

from llm_fixtures import documents  # noqa: F401
from tickloom.llm.queries import VOCABULARY
from tickloom.llm.token_counts import Automaton, PieceCounter, count_tokens, read_vocabulary

SMALL = [b"abcdefgh", b"bcd", b"cde", b"ab", b"abc", b"defg", b"fgh", b"hhhhh", b"hh", b" a", b" abcd", b""]


def brute(data, vocabulary):
    known = set(vocabulary) | {bytes([b]) for b in range(256)}
    longest, count = max(map(len, known)), 0
    while data:
        n = next(n for n in range(min(longest, len(data)), 0, -1) if data[:n] in known)
        data, count = data[n:], count + 1
    return count


def test_counts_equal_greedy_segmentation():
    rng = random.Random(1)
    counter = PieceCounter(Automaton.build(SMALL))
    for _ in range(4000):
        data = bytes(97 + (i if rng.random() < 0.8 else rng.randrange(8)) % 8 for i in range(rng.randrange(40)))
        assert counter.count(data) == brute(data, SMALL)
        assert counter[data] == brute(b" " + data, SMALL)
    assert counter.count(b"") == 0


def test_public_vocabulary(spark, documents):
    vocabulary = read_vocabulary(VOCABULARY)
    texts = [None, "", " \t\n", "the theatre", "Ünïcödé 漢字", "a" * 5000, "x\u00a0y", "the theatre"]
    got = count_tokens(documents(*enumerate(texts), extra=True), vocabulary, ["doc_id"]).collect()
    for r in got:
        words = (texts[r.doc.doc_id] or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(brute(b" " + w, vocabulary) for w in words))
    assert count_tokens(documents((1, "a")).limit(0), vocabulary).count() == 0


def test_a_vocabulary_has_a_bound(tmp_path, monkeypatch):
    import tickloom.llm.token_counts as module

    monkeypatch.setattr(module, "MOST_TOKENS", 1)
    (tmp_path / "v.json").write_text('{"model": {"vocab": {"a": 0, "b": 1}}}')
    with pytest.raises(ValueError):
        read_vocabulary(str(tmp_path / "v.json"))

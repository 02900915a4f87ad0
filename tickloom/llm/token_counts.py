"""Token counts by greedy longest match, without building the pieces."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from tickloom.llm.common import map_texts

# A vocabulary file is a model, not data: it stays below this many entries.
MOST_TOKENS = 1_000_000
# Distinct words whose lengths a worker remembers before it starts anew.
REMEMBERED = 300_000
# What stands before the first piece of a word in the vocabulary.
WORD_START = b" "


def read_vocabulary(path: str) -> list[bytes]:
    """The byte strings of a byte-level vocabulary file (``model.vocab`` of its JSON form).

    Such files write bytes as printable characters: the printable ones of Latin-1 stand for
    themselves, the others, in order, for U+0100 and above.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_byte = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in as_byte.values()]
    as_byte |= {chr(256 + i): b for i, b in enumerate(others)}
    entries = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
    if len(entries) > MOST_TOKENS:
        raise ValueError(f"{path} has {len(entries)} entries, more than {MOST_TOKENS}")
    return [bytes(as_byte[c] for c in e) for e in entries if all(c in as_byte for c in e)]


class Automaton(NamedTuple):
    """The trie of a vocabulary with failure links, as arrays.

    Where a node has no child for the next byte, ``fail`` leads to the node of what is left
    after the longest pieces are taken off its string, and ``popped`` says how many those are.
    A child is filed under ``node << 8 | byte``. A byte that no piece starts with is a piece.
    """

    edges: np.ndarray
    children: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    @staticmethod
    def build(vocabulary: list[bytes]) -> Automaton:
        known = {p for p in vocabulary if p} | {bytes([b]) for b in range(256)}
        child: dict[int, int] = {}
        fail, popped = [0], [0]
        level = {b"": 0}
        depth, left = 0, sorted(known)
        while left:  # nodes of one depth at a time: links lead to shallower nodes
            depth += 1
            following: dict[bytes, int] = {}
            for string in dict.fromkeys(p[:depth] for p in left):
                parent, byte = level[string[:-1]], string[-1]
                following[string] = child[parent << 8 | byte] = len(fail)
                if string in known:
                    fail.append(0)
                    popped.append(1)
                    continue
                at, count = fail[parent], popped[parent]
                while at << 8 | byte not in child:
                    count += popped[at]
                    at = fail[at]
                fail.append(child[at << 8 | byte])
                popped.append(count)
            level, left = following, [p for p in left if len(p) > depth]
        return Automaton(*(np.array(x, np.int64) for x in (list(child), list(child.values()), fail, popped)))


class PieceCounter(dict):
    """Word to number of pieces of its greedy longest-match segmentation; linear in the word."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.child = dict(zip(automaton.edges.tolist(), automaton.children.tolist(), strict=True))
        self.fail, self.popped = automaton.fail.tolist(), automaton.popped.tolist()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.count(WORD_START + word)
        return found

    def count(self, data: bytes) -> int:
        child, fail, popped = self.child, self.fail, self.popped
        at = count = 0
        for byte in data:
            key = at << 8 | byte
            while key not in child:
                count += popped[at]
                at = fail[at]
                key = at << 8 | byte
            at = child[key]
        while at:
            count += popped[at]
            at = fail[at]
        return count


def _counter(automaton: Automaton):
    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        pieces = PieceCounter(automaton).__getitem__
        for texts in batches:
            words = (t.split() if t else () for t in texts)
            counts = [(len(w), sum(map(pieces, w))) for w in words]
            yield [[w for w, _ in counts], [t for _, t in counts]]

    return work


def count_tokens(docs: DataFrame, vocabulary: list[bytes], keep: list[str] | None = None) -> DataFrame:
    """``(doc, n_words, n_tokens)``, one row per document row.

    ``doc`` holds the columns ``keep`` of ``docs`` (all, if None), whose ``text`` is cut at ASCII
    white space. Each word, with a space before it, is segmented greedily: the longest piece
    of the vocabulary first, again and again. ``n_tokens`` counts the pieces.

    Null and empty texts have no words. Case and all other bytes count as they are. Repeated
    documents are counted each. No document, no row. The automaton of the vocabulary, a bounded
    model file, is sent to the tasks; the rows are streamed and nothing is shuffled.
    """
    return map_texts(docs, "n_words long, n_tokens long", _counter(Automaton.build(vocabulary)), keep)

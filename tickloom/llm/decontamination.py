"""Benchmark decontamination: FM-indexes over shards of the corpus, searched for test phrases."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import drop_stored, map_texts, store
from tickloom.llm.fm_index import FmIndex

WINDOW = 13
# Words that one index covers; a longer document is cut into overlapping pieces.
SHARD_WORDS = 1_000_000
# Benchmark words that go to the tasks at once; a longer benchmark is met block by block.
BLOCK_WORDS = 200_000
# A document with this share of hit words, one in twenty, is contaminated.
HIT_SHARE = 20

_KIND = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<word:long,end_word:long,start:long,end:long>>"
)
# Bytes of a word: digits, letters and all of UTF-8 beyond ASCII. Others separate words.
_IS_WORD = [48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if _IS_WORD[b] else 32 for b in range(256))
# The same as a pattern over code points.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IS_WORD_BYTE = np.array(_IS_WORD, np.int8)
# Symbols of an index: its end, a run of words that no phrase holds, then the phrases' words.
_OTHER = 1


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Phrases:
    """The distinct windows of a block of benchmark items, as symbols."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words_of(text)]
            for start in range(max(len(ids) - window, 0) + 1 if ids else 0):
                holders.setdefault(tuple(ids[start : start + window]), set()).add(item_id)
        self.holders = [sorted(x) for x in holders.values()]
        self.lengths = np.array([len(p) for p in holders], np.int64)
        self.patterns = np.zeros((len(holders), max(self.lengths, default=0)), np.int64)
        for row, pattern in enumerate(holders):
            self.patterns[row, : len(pattern)] = pattern
        self.bits = max(2, (len(self.vocabulary) + 1).bit_length())


def _shard_hits(
    phrases: Phrases, pieces: list[tuple[int, int, np.ndarray]]
) -> Iterator[tuple[int, int, int, int]]:
    """``(document, first word, end word, phrase)`` of all occurrences in one shard.

    A piece is ``(document, number of its first word, symbols)``. Neighbouring words that no
    phrase holds become one symbol, and so does the gap between two pieces.
    """
    rows, offsets, kept, symbols = [], [], [], []
    for row, offset, ids in pieces:
        ids = np.append(ids, _OTHER)
        keep = np.flatnonzero((ids != _OTHER) | np.concatenate(([True], ids[:-1] != _OTHER)))
        rows.append(np.full(len(keep), row))
        offsets.append(keep + offset)
        symbols.append(ids[keep])
    row_of, word_of, text = np.concatenate(rows), np.concatenate(offsets), np.concatenate(symbols)
    index = FmIndex(text, phrases.bits)
    low, high = index.search(phrases.patterns, phrases.lengths)
    found = np.flatnonzero(high > low)
    for begin in range(0, len(found), 1000):
        some = found[begin : begin + 1000]
        count = high[some] - low[some]
        phrase = np.repeat(some, count)
        places = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[phrase]
        at = index.locate(places)
        first = word_of[at]
        yield from zip(
            row_of[at].tolist(), first.tolist(), (first + phrases.lengths[phrase]).tolist(),
            phrase.tolist(), strict=True,
        )


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _in_code_points(text: bytes, spans: list[list[int]]) -> list[dict]:
    """Word spans as spans of code points."""
    data = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(_IS_WORD_BYTE[data], prepend=0, append=0))
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    places = starts[edges]
    return [
        {
            "word": a, "end_word": b,
            "start": int(places[2 * a]), "end": int(places[2 * b - 1]),
        }
        for a, b in spans
    ]


def _finder(phrases: Phrases, window: int, shard_words: int):
    lookup = phrases.vocabulary.get

    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        for texts in batches:
            counts = [0] * len(texts)
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            pieces, size = [], 0

            def flush(pieces, spans=spans, items=items):
                for row, start, end, phrase in _shard_hits(phrases, pieces) if pieces else ():
                    spans.setdefault(row, []).append((start, end))
                    items.setdefault(row, set()).update(phrases.holders[phrase])

            for row, text in enumerate(texts):
                words = words_of(text)
                counts[row] = len(words)
                ids = np.fromiter(map(lookup, words, repeat(_OTHER)), np.int32, len(words))
                del words
                for start in range(0, len(ids), shard_words):
                    piece = ids[max(start - window + 1, 0) : start + shard_words]
                    if size + len(piece) > shard_words:
                        flush(pieces)
                        pieces, size = [], 0
                    pieces.append((row, max(start - window + 1, 0), piece))
                    size += len(piece)
            flush(pieces)
            merged = {row: _merged(s) for row, s in spans.items()}
            cuts = [_in_code_points(texts[r], merged[r]) if r in merged else [] for r in range(len(texts))]
            hit = [sum(b - a for a, b in merged.get(r, ())) for r in range(len(texts))]
            yield [counts, hit, [sorted(items.get(r, ())) for r in range(len(texts))], cuts]

    return work


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(doc, n_words, n_hit, items, spans, contaminated)``, one row per document row.

    ``doc`` holds the columns ``keep`` of ``docs`` (all, if None). Words are runs of digits, a-z
    (A-Z lower-cased) and characters beyond ASCII. A window is ``window`` neighbouring words of
    an item, or all words of a shorter one. ``n_hit`` counts the document words inside any
    occurrence, ``items`` holds the ids (as strings) of the items with occurring windows,
    ``spans`` the merged stretches to remove, as numbers of words and in code points, the ends
    exclusive. A document is contaminated if at least one word in twenty is hit.

    Null or empty texts have no words and no hits; an item without words or without an id has
    no window. Repeated items count once by their id, repeated documents are judged each. An
    empty benchmark hits nothing. No document, no row.

    Each task indexes its documents in shards of ``shard_words`` words: a suffix order, its
    wavelet matrix for ranks, and sampled positions. All phrases are searched backwards in each
    shard. No document is shuffled; memory follows the shard and not the table. Phrases go to
    the tasks in blocks of about ``block_words`` words, which are numbered by a hash of the item in a
    stored table; the driver hands on one block at a time. If there are more, each block is a pass
    of its own over the rows, stored before the next, and spans and items of the passes are united.
    """
    state = docs.select(
        F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)]).alias("doc"), "text"
    )
    blocks, count = _blocks(benchmark, block_words)
    stored = None
    for number in range(count):
        items = [(r["item_id"], bytes(r["text"])) for r in blocks.where(F.col("block") == number).collect()]
        more = number + 1 < count
        # Texts come back from the tasks only if another block needs them.
        kept = ["doc", *(["items", "spans"] if number else []), *(["text"] if more else [])]
        found = map_texts(state, _KIND, _finder(Phrases(items, window), window, shard_words), kept)
        hit, ids, spans = F.col("n_hit"), F.col("items"), F.col("spans")
        if number:
            spans = _united(F.col("doc.spans"), spans)
            ids = F.array_sort(F.array_union("doc.items", "items"))
            hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end_word"] - x["word"])
        state = found.select(
            "doc.doc", *(["doc.text"] if more else []), "n_words", hit.alias("n_hit"),
            ids.alias("items"), spans.alias("spans"),
        )
        if more:
            state, before = store(state, "searched"), stored
            if before:
                drop_stored(before)
            stored = state
    return state.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))
    )


def _blocks(benchmark: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """``(item_id, text, block)`` of the distinct items, stored, and the number of blocks (1 at least)."""
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"),
        F.regexp_count("text", F.lit(_WORD)).alias("n_words"),
    ).distinct()
    items = store(rows, "benchmark-items")
    words = items.agg(F.sum("n_words")).first()[0] or 0
    count = max(-(-words // block_words), 1)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    if count == 1:
        return items.withColumn("block", block), 1
    # Dealt by block and written in that order, so that a block is read from few row groups.
    blocks = items.withColumn("block", block).repartition("block").sortWithinPartitions("block")
    return store(blocks, "benchmark-blocks"), count


def _united(left: Column, right: Column) -> Column:
    """Both span lists as one, overlapping and touching spans merged."""

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(
            last["word"].alias("word"), F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
            last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"),
        )
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end_word"] >= x["word"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(x)))

    both = F.array_sort(F.concat(left, right))
    return F.aggregate(both, F.slice(both, 1, 0), add)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without its ``spans`` (in order, in code points)."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int")))
    return F.array_join(kept, "")

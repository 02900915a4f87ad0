"""Repeated passages, found by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import map_texts, store

# A chunk ends where the rolling hash is smallest within so many bytes on either side.
REACH = 20
# No chunk is longer, even where the text gives no end.
LONGEST = 256
# Neighbouring chunks that are compared as one.
CHUNKS = 2
# A repeated stretch counts if it covers so many code points (about 20 words), or a window below.
LEAST = 120
# Chunks across the ends of a passage are not shared, and any number of bytes may hold no end. So
# windows of so many words are compared too: one at least of any FOUND_WORDS words that follow each other.
WINDOW_WORDS, FOUND_WORDS = 24, 50

_U = np.uint64
# Digests of windows are never those of chunks.
_WINDOW_SEED = 1
# The gear: a fixed random number per byte.
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear rolling hash at each byte: ``h = (h << 1) + gear[byte]``, over 32 bytes.

    The sum over a window of 2k bytes is that over its last k bytes plus the shifted one over
    the k before, so five doublings give all of them.
    """
    h, width = _GEAR[data], 1
    while width < 32:
        longer = h.copy()
        longer[width:] += h[:-width] << _U(width)
        h, width = longer, width * 2
    return _mixed_top(h)


def _mixed_top(h: np.ndarray) -> np.ndarray:
    """The top bits, which depend on all 32 bytes most evenly, as the number to compare."""
    return (h << _U(32)) >> _U(32)


def _least_of_next(h: np.ndarray, reach: int) -> np.ndarray:
    """At each place, the smallest of the ``reach`` numbers after it."""
    out = np.full(len(h) + reach, np.iinfo(np.uint64).max, np.uint64)
    out[: len(h)] = h
    width = 1
    while width < reach:
        step = min(width, reach - width)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out[1 : len(h) + 1] if reach else out


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ends (exclusive) of the chunks of UTF-8 bytes; the last is the length.

    A place is an end if its hash is smaller than the ``REACH`` before it and not larger than
    the ``REACH`` after it: what the bytes around decide, so that an insertion moves no other
    end. Only starts of code points are ends. Longer gaps are cut every ``LONGEST`` bytes.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    h = gear_hashes(data)
    h[(data & 0xC0) == 0x80] = np.iinfo(np.uint64).max
    after = _least_of_next(h, REACH)
    before = _least_of_next(h[::-1], REACH)[::-1]
    ends = np.flatnonzero((h < before) & (h <= after))
    ends = np.unique(np.concatenate((ends[ends > 0], [n])))
    starts = np.concatenate(([0], ends[:-1]))
    long = ends - starts > LONGEST
    if long.any():
        whole = (data & 0xC0) != 0x80
        more = []
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            cut = a + LONGEST
            while cut < b:
                while cut > a and not whole[cut]:
                    cut -= 1
                more.append(cut)
                cut += LONGEST
        ends = np.unique(np.concatenate((ends, more)).astype(np.int64))
    return ends


# Powers of an odd number, and of its inverse, modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """The first so many powers, made anew when a longer text needs more."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.array([1] + [b] * (size - 1), np.uint64), dtype=np.uint64) for b in (_BASE, _INVERSE)
            )
        return self.up[:n], self.down[:n]


def window_places(data: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the windows of ``WINDOW_WORDS`` words that are compared.

    Words are split at ASCII white space. Of any ``FOUND_WORDS`` words in a row, a window with
    the smallest hash among theirs is taken; of equal ones that which an earlier stretch of
    words took, else the last. So equal stretches of that length have an equal window, and a
    run of equal windows is taken only once in so many words.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    word = np.concatenate(([False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]))
    starts, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    if len(starts) < FOUND_WORDS:
        return none
    starts, ends = starts[: len(starts) - WINDOW_WORDS + 1], ends[WINDOW_WORDS - 1 :]
    up, down = powers.of(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_GEAR[data] * up, dtype=np.uint64)))
    h = (total[ends] - total[starts]) * down[starts]
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    width = FOUND_WORDS - WINDOW_WORDS + 1
    rows = np.lib.stride_tricks.sliding_window_view(h, width)
    least = rows.min(axis=1)
    last = (np.arange(len(rows)) + width - 1 - rows[:, ::-1].argmin(axis=1)).tolist()
    # Where the least hash is another than one stretch of words before.
    changes = [*(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(rows)]
    taken, at = [], 0
    for change in changes:
        while at < change:
            taken.append(last[at])
            at = last[at] + 1
        at = change
    taken = np.unique(np.array(taken, np.int64))
    return starts[taken], ends[taken]


def _chunker():
    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        digest, powers = xxhash.xxh3_64_intdigest, _Powers()
        for texts in batches:
            digests, spans = [], []
            for text in texts:
                data = np.frombuffer(text or b"", np.uint8)
                ends = chunk_ends(data)
                edges = np.concatenate(([0], ends)) if len(ends) else ends
                if len(ends) < CHUNKS:
                    starts, stops = edges[:1], ends[-1:]
                else:
                    starts, stops = edges[: len(ends) - CHUNKS + 1], edges[CHUNKS:]
                from_, to = window_places(data, powers)
                pairs = zip(starts.tolist(), stops.tolist(), strict=True)
                windows = zip(from_.tolist(), to.tolist(), strict=True)
                found = [digest(text[a:b]) for a, b in pairs]
                found += [digest(text[a:b], _WINDOW_SEED) for a, b in windows]
                starts, stops = np.concatenate((starts, from_)), np.concatenate((stops, to))
                is_window = np.arange(len(starts)) >= len(starts) - len(from_)
                place = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                digests.append(np.array(found, np.uint64).view(np.int64))
                spans.append((place[starts] << 32) | (place[stops] - place[starts]) << 1 | is_window)
            yield [digests, spans]

    return work


# A document is known by its id and its text together: ids may be null, or repeat.
_DOC, _FIRST = ("doc_id", "text_hash"), ("first_doc_id", "first_text_hash")


def _numbered(spans: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``spans`` with the number of the stretch, of touching or overlapping spans of equal keys, that each is in."""
    in_order = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    return spans.withColumn("opens", opens).withColumn(name, F.sum("opens").over(in_order)).drop("opens")


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id, start, end, first_doc_id, first_start, text_hash, first_text_hash)``: what stood before.

    Of all places of a stretch of text, the one in the smallest doc_id (null first), of equal ids in
    the smaller hash of the text, and there the earliest, is kept; a row per other place tells
    what to cut (code points, end exclusive) and where the kept one is. The two stretches of a row
    hold the same text; where parts of a passage are kept in different documents there is a
    row for each, and these may overlap. In a run, where like follows like within a document, the place
    named is the one just before, so that a run is one row. Stretches are made of content-defined chunks and of windows
    of 24 words, so they may begin and end some words inside of what the documents share; what covers,
    with the stretches it touches, less than ``least`` code points and no window is left alone.
    Any 50 words in a row (split at ASCII white space) that stood before have a window that did.

    Null and empty texts repeat nothing; a text shorter than two chunks is compared as a
    whole. A document is known by its doc_id and text together: a repeated row, also one without
    an id, is the same document and repeats nothing; different texts with one doc_id, or without
    any, are documents of their own. Other columns are left out. No document, no row.

    The texts are read once; digests of neighbouring chunks and of windows meet in an aggregation that
    merges within the tasks first, so a passage in a third of all documents is one row a task.
    The places of the repeated digests come from an equi-join, which Spark splits where one
    digest has many places. Only then are places ordered, by document.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    chunks = map_texts(texts, "digests array<long>, spans array<long>", _chunker(), list(_DOC))
    # Stored as short arrays, one row a document: the texts are not read again for the join.
    chunks = store(chunks.select("doc.*", "digests", "spans"), "chunks")
    places = chunks.select(*_DOC, F.explode(F.arrays_zip("digests", "spans")).alias("c")).select(
        *_DOC, F.col("c.digests").alias("digest"), F.col("c.spans").alias("span")
    )
    # The length follows from the digest.
    place = F.struct(*_DOC, F.shiftright("span", 32).alias("start"))
    firsts = places.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    inside = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    again = places.join(firsts.where("n > 1").drop("n"), "digest").where(~place.eqNullSafe(F.col("first"))).select(
        *_DOC, F.when(inside, F.col("digest")).alias("own_digest"), F.shiftright("span", 32).alias("start"),
        (F.shiftright("span", 32) + F.shiftright(F.col("span").bitwiseAND(0xFFFFFFFF), 1)).alias("end"),
        F.col("span").bitwiseAND(1).alias("window"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.text_hash").alias("first_text_hash"),
        F.col("first.start").alias("first_start"),
    )
    # All that follows keeps to a document: one shuffle.
    again = again.repartition(*_DOC)
    like = Window.partitionBy(*_DOC, "own_digest").orderBy("start")
    before = F.coalesce(F.lag("start").over(like), "first_start")
    in_run = F.col("own_digest").isNotNull() & (F.col("start") - before <= F.col("end") - F.col("start"))
    again = again.withColumn("shift", F.when(in_run, before).otherwise(F.col("first_start")) - F.col("start"))
    # Spans kept at one distance in one document are one stretch there as well.
    same = [*_DOC, *_FIRST, "shift"]
    pieces = _numbered(again, same, "piece").groupBy(*same, "piece").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("window").alias("window")
    )
    whole = Window.partitionBy(*_DOC, "stretch")
    size = F.max("end").over(whole) - F.min("start").over(whole)
    judged = _numbered(pieces, list(_DOC), "stretch").withColumn(
        "counts", (size >= least) | (F.max("window").over(whole) == 1)
    )
    return judged.where("counts").select(
        "doc_id", "start", "end", "first_doc_id", (F.col("start") + F.col("shift")).alias("first_start"),
        "text_hash", "first_text_hash",
    )


def cut_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the ``spans`` of ``repeated_spans`` cut out of ``text``.

    Spans are cut from the rows with their doc_id (null too) and text; overlapping ones are cut
    once. All rows stay: null and empty texts as they are, a text that is cut whole becomes empty,
    repeated rows are cut alike. Texts of any length are cut whole, other columns come along
    under whatever names. No document, no row; without spans every text stays.
    """
    cuts = _numbered(spans.select(*_DOC, "start", "end"), list(_DOC), "stretch").groupBy(*_DOC, "stretch").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    per_doc = cuts.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = docs.select(row, docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"))
    known = rows["doc_id"].eqNullSafe(per_doc["doc_id"]) & (rows["text_hash"] == per_doc["text_hash"])
    text = F.when(F.col("cuts").isNull(), F.col("doc.text")).otherwise(_without(F.col("doc.text"), F.col("cuts")))
    return rows.join(per_doc, known, "left").select(
        *[text.alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )


def _without(text: Column, cuts: Column) -> Column:
    """``text`` without the ``cuts``, which are in order and apart."""
    from_zero = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    to_end = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    pieces = F.zip_with(
        from_zero, to_end, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int"))
    )
    return F.array_join(pieces, "")

"""Which sources of a language use its terms differently, and which terms tell them apart."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import store, terms_of

# What binds op11: documents of a language that a kept term is in, counts added to each term,
# shares written as whole numbers of 1 / SCALE, ranks of the terms.
LEAST_DOCS, SMOOTHING, SCALE, TOP = 30, 5, 10**9, 50
# Entries that a task counts before it sends them on.
HELD = 400_000
# Terms and sources that a block of the distances between sources holds, on average.
BLOCK_TERMS, BLOCK_SOURCES = 1024, 256
# Tasks that a group's bands meet in before they meet in one.
MERGERS = 16
# Terms that are held against the retained ones at a time.
CHUNK = 512

_COUNTED = "lang string, source string, term string, count long, docs long"
_GROUP = ["lang", "source"]
_STANDING = "lang string, source string, term string, count long, lang_count long"


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per group and term, as far as a task has room for them."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in counts.items():
            terms = list(occurrences)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(occurrences.values(), pa.int64()),
                    pa.array([documents[t] for t in terms], pa.int64()),
                ],
                ["lang", "source", "term", "count", "docs"],
            )
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = terms_of(text)
            occurrences, documents = counts.setdefault((lang, source), (Counter(), Counter()))
            before = len(occurrences)
            occurrences.update(words)
            documents.update(set(words))
            held += len(occurrences) - before
            if held > HELD:
                yield from flush()
                held = 0
    yield from flush()


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(lang, source, term, count, lang_count, first)`` of the terms that a language keeps.

    A task counts what it reads before anything is shuffled, once, by language and term; a
    language's totals come from a window over the sources of a term. ``first`` is 1 in one row
    of each language and term.
    """
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    ).where("text is not null")
    counted = (
        rows.mapInArrow(_tally, _COUNTED).repartition("lang", "term").groupBy(*_GROUP, "term")
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    )
    term = Window.partitionBy("lang", "term")
    return counted.select(
        *_GROUP, "term", "count", F.sum("count").over(term).alias("lang_count"),
        (F.col("source") == F.min("source").over(term)).cast("long").alias("first"),
        F.sum("docs").over(term).alias("docs"),
    ).where(F.col("docs") >= least_docs).drop("docs")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, n, lang_n, v, sources)`` of every group that has a document."""
    groups = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")
    ).distinct()
    sums = kept.groupBy(*_GROUP).agg(F.sum("count").alias("n"), F.sum("first").alias("terms"))
    sized = groups.join(sums, _GROUP, "left").na.fill(0, ["n", "terms"])
    langs = sized.groupBy("lang").agg(
        F.sum("n").alias("lang_n"), F.sum("terms").alias("v"), F.count("*").alias("sources")
    )
    return sized.select(*_GROUP, "n").join(langs, "lang")


def share(count: Column, total: Column, terms: Column, smoothing: int = SMOOTHING) -> Column:
    """``1 + floor(SCALE * (count + smoothing) / (total + smoothing * terms))``, exactly."""
    part = (count + smoothing).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.greatest(total + smoothing * terms, F.lit(1))  # without kept terms nothing is shared
    return 1 + F.call_function("div", part, whole.cast("decimal(20,0)"))


# --- terms ------------------------------------------------------------------------------


def _prefixes(terms: list[bytes]) -> np.ndarray:
    """The first eight bytes as numbers in the order of the bytes; terms hold no zero byte."""
    return np.array(terms, "S8").view(">u8").astype(np.uint64)


class Skyband:
    """The terms of one group that fewer than k others dominate.

    A term dominates another if its group count is not lower, its language count not higher, and
    its UTF-8 earlier. It ranks before the other then, whatever the totals of group and
    language are. Terms come by falling count, then rising language count, then UTF-8, so
    that a term's dominators come before it; those of them that were not retained have k
    retained dominators of their own, which dominate the term, too.
    """

    def __init__(self, k: int):
        self.k = k
        self.lang_counts, self.prefixes = np.empty(0, np.int64), np.empty(0, np.uint64)
        self.terms: list[bytes] = []

    def _dominators(
        self, lang_counts: np.ndarray, prefixes: np.ndarray, terms: list[bytes], of: tuple, before: bool
    ) -> np.ndarray:
        counts, starts, others = of
        lower = counts[None, :] <= lang_counts[:, None]
        if before:
            lower &= np.tri(len(terms), k=-1, dtype=bool)
        found = (lower & (starts[None, :] < prefixes[:, None])).sum(1)
        for i, j in np.argwhere(lower & (starts[None, :] == prefixes[:, None])):
            found[i] += others[j] < terms[i]
        return found

    def retain(self, lang_counts: np.ndarray, terms: list[bytes]) -> np.ndarray:
        """Which of the next terms stay."""
        prefixes = _prefixes(terms)
        own = (lang_counts, prefixes, terms)
        found = self._dominators(*own, (self.lang_counts, self.prefixes, self.terms), False)
        stay = np.flatnonzero(found + self._dominators(*own, own, True) < self.k)
        self.lang_counts = np.concatenate((self.lang_counts, lang_counts[stay]))
        self.prefixes = np.concatenate((self.prefixes, prefixes[stay]))
        self.terms += [terms[i] for i in stay]
        return stay


def _banded(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Skyband(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            terms = [t.encode() for t in batch.column("term").to_pylist()]
            lang_counts = batch.column("lang_count").to_numpy()
            ends = [i for i in range(1, len(own)) if own[i] != own[i - 1]] + [len(own)]
            stay, start = [], 0
            for end in ends:
                if own[start] != group:
                    group, band = own[start], Skyband(k)
                for at in range(start, end, CHUNK):
                    to = min(at + CHUNK, end)
                    stay.append(at + band.retain(lang_counts[at:to], terms[at:to]))
                start = end
            yield batch.take(pa.array(np.concatenate(stay)))

    return run


def skybands(kept: DataFrame, k: int = TOP) -> DataFrame:
    """The rows of ``kept`` that fewer than ``k`` others of their group dominate (``Skyband``).

    Every partition retains its own band, streaming through its sorted rows; bands meet in a
    few tasks per group, then in one. A task holds the band of one group at a time.
    """
    def banded(rows: DataFrame) -> DataFrame:
        order = [*_GROUP, F.desc("count"), "lang_count", "term"]
        return rows.sortWithinPartitions(*order).mapInArrow(_banded(k), _STANDING)

    own = banded(kept.select(*_GROUP, "term", "count", "lang_count"))
    some = banded(own.repartition(*_GROUP, F.pmod(F.xxhash64("term"), F.lit(MERGERS))))
    return banded(some.repartition(*_GROUP))


def telling_terms(kept: DataFrame, sizes: DataFrame, top: int = TOP, smoothing: int = SMOOTHING) -> DataFrame:
    """The ``top`` terms whose share in a group exceeds their share in the language most."""
    p = share(F.col("count"), F.col("n"), F.col("v"), smoothing)
    q = share(F.col("lang_count"), F.col("lang_n"), F.col("v"), smoothing)
    found = skybands(kept, top).join(sizes, _GROUP).select(
        *_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")
    )
    return _ranked(found.where("value > 0")).where(F.col("rank") <= top)


# --- sources ----------------------------------------------------------------------------


def _distances(block: pd.DataFrame) -> pd.DataFrame:
    """Summed differences of the shares of one block's terms, for each pair of its sources.

    A row without a term gives a source's share of the terms that it does not have.
    """
    zeros = block[block["term"].isna()]
    place = {source: i for i, source in enumerate(zeros["source"])}
    used = block[block["term"].notna()]
    codes, terms = pd.factorize(used["term"])
    shares = np.repeat(zeros["p"].to_numpy()[:, None], len(terms), axis=1)
    shares[used["source"].map(place).to_numpy(np.int64), codes] = used["p"].to_numpy()
    side, one, other = zeros["side"].to_numpy(), block["one"].iat[0], block["other"].iat[0]
    names = zeros["source"].to_numpy(object)
    out = []
    for i in np.flatnonzero(side == one):
        against = np.arange(i + 1, len(names)) if one == other else np.flatnonzero(side == other)
        sums = np.abs(shares[against] - shares[i]).sum(axis=1)
        out.append(pd.DataFrame({"a": names[i], "b": names[against], "value": sums}))
    found = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "value": []})
    return found.assign(lang=block["lang"].iat[0])[["lang", "a", "b", "value"]]


def source_distances(kept: DataFrame, sizes: DataFrame, smoothing: int = SMOOTHING) -> DataFrame:
    """Summed differences of all shares, for each group and each other source of its language.

    The shares of a language form a table of sources by terms, which is cut into blocks of either
    kind. A block is one group of rows; what a source lacks there is one number. With more
    than ``BLOCK_SOURCES`` sources, blocks of sources meet in pairs.
    """
    def blocks(number: Column, per_block: int) -> Column:
        return F.greatest(F.ceil(number / per_block), F.lit(1)).cast("long")

    cut = sizes.select(
        "*", blocks(F.col("v"), BLOCK_TERMS).alias("n_blocks"), blocks(F.col("sources"), BLOCK_SOURCES).alias("n_sides")
    ).withColumn("side", F.pmod(F.xxhash64("source"), F.col("n_sides")))
    p = share(F.coalesce("count", F.lit(0)), F.col("n"), F.col("v"), smoothing)
    used = kept.join(cut, _GROUP).withColumn("block", F.pmod(F.xxhash64("term"), F.col("n_blocks")))
    lacking = cut.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    lacking = lacking.withColumns({"term": F.lit(None).cast("string"), "count": F.lit(0).cast("long")})
    columns = [*_GROUP, "term", "count", "n", "v", "block", "side", "n_sides"]
    rows = used.select(*columns).union(lacking.select(*columns)).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_sides") - 1)).alias("met")
    )
    sums = rows.select(
        *_GROUP, "term", p.alias("p"), "block", "side",
        F.least("side", "met").alias("one"), F.greatest("side", "met").alias("other"),
    ).groupBy("lang", "block", "one", "other").applyInPandas(
        _distances, "lang string, a string, b string, value long"
    ).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("pair")
    return _ranked(sums.select("lang", "value", both).select(
        "lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value"
    ))


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    return found.select(*_GROUP, "part", "item", "value", F.row_number().over(order).alias("rank"))


def divergence_audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, smoothing: int = SMOOTHING
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of the documents' ``lang, source, text``.

    Part ``pair`` ranks the other sources of a group's language by the summed differences of their
    term shares, all of them; part ``term`` ranks the ``top`` terms whose share in the group
    exceeds their share in the language most. A language keeps the terms that are in at least
    ``least_docs`` of its documents. Shares are whole numbers, so all sums are exact.

    Null texts, languages and sources are read as empty. A group without terms has part ``pair``
    only, with value 0 throughout if its language keeps no term; a language with one source has
    no part ``pair``. Repeated rows count each. Equal values are ordered by the UTF-8 of the
    item. Very long texts count whole. Other columns have no influence. No document, no row.
    """
    docs = docs.select("lang", "source", "text")
    kept = store(kept_counts(docs, least_docs), "divergence-counts")
    sizes = store(group_sizes(docs, kept), "divergence-sizes")
    return source_distances(kept, sizes, smoothing).union(telling_terms(kept, sizes, top, smoothing))

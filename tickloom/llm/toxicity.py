"""Toxicity of documents, by their nearest labelled examples."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.block_max import BlockMaxIndex
from tickloom.llm.common import map_texts, store, terms_of
from tickloom.llm.language_id import held_out
from tickloom.llm.ngram_join import shingle_set

# Distinct labelled texts of either label that are learned from, at most, and terms of the vectors.
EXAMPLES, VOCABULARY = 5_000, 5_000
# Neighbours that vote, and neighbours that are named.
NEIGHBOURS, NAMED = 25, 3
# What is added to a distance before its inverse weighs a vote.
NEAR = 0.05
# From this score on a document is predicted to be toxic.
TOXIC_FROM = 0.3
# One in so many examples calibrates and is no neighbour.
CALIBRATES = 4
# How often chance may make a term of the vocabulary seem to tell the labels apart.
CHANCE = 0.01
# Examples are near copies if they agree in one of BANDS pairs of minimum hashes of five words.
BANDS = 4
# Distinct vectors whose scores a worker remembers.
REMEMBERED = 100_000

_EVIDENCE = "array<struct<example: long, similarity: double, toxic: int>>"


class Example(NamedTuple):
    doc_id: int | None
    toxic: int
    terms: list[int]
    counts: list[int]


# --- what is learned ---------------------------------------------------------------------


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(toxic, place, doc_id)``: the distinct texts of labelled documents that may be learned from.

    ``place`` is a hash of the text. A document with several labels has the largest. Only ids and
    hashes are shuffled.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("labelled"))
    known = known.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", _place().alias("place"))
    return (
        usable.join(known, F.col("doc_id") == F.col("labelled"))
        .groupBy("toxic", "place").agg(F.min("doc_id").alias("doc_id"))
    )


def _place() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _sampled(labelled: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` rows of either label: those with the least hashes.

    Hashes are even, so a bound on the hash leaves hardly more rows than are wanted; only these
    are put in order.
    """
    below = F.lit(False)
    for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        share = min(1.0, (most + 6 * math.sqrt(most)) / row["n"])
        bound = min(int(-(2**63) + share * 2**64), 2**63 - 1)
        below = F.when(F.col("toxic") == row["toxic"], F.col("place") <= bound).otherwise(below)
    order = Window.partitionBy("toxic").orderBy("place")
    return labelled.where(below).withColumn("number", F.row_number().over(order)).where(F.col("number") <= most).drop("number")


def _described(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
    """Terms, their counts, and the near-copy bands of each text."""
    for texts in batches:
        columns: list[list] = [[], [], []]
        for text in texts:
            counts = Counter(terms_of(text or b""))
            shingles = shingle_set(text, xxhash.xxh3_64_intdigest, 5)
            bands = []
            for i in range(BANDS if len(shingles) else 0):
                pair = [int(((shingles ^ np.uint64(2 * i + j + 1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * (2 * i + j))).min()) for j in range(2)]
                bands.append(xxhash.xxh3_64_intdigest(f"{i}:{pair}") >> 1)
            row = ([w.decode() for w in counts], list(counts.values()), bands)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        yield columns


def _examples(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``(toxic, place, doc_id, words, counts, bands)`` of the sampled texts, each read once."""
    chosen = F.broadcast(sample.select(F.col("place").alias("chosen")).distinct())
    texts = docs.select(_place().alias("place"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(chosen, F.col("place") == F.col("chosen")).groupBy("place").agg(F.min("text").alias("text"))
    described = map_texts(texts, "words array<string>, counts array<int>, bands array<long>", _described, ["place"])
    return sample.join(described.select(F.col("doc.place").alias("place"), "words", "counts", "bands"), "place")


def _independent(rows: list) -> list[tuple[int, int]]:
    """``(toxic, place)`` without near copies of an earlier example of the label."""
    seen: set[tuple[int, int]] = set()
    out = []
    for row in sorted(rows, key=lambda r: (r["toxic"], r["place"])):
        bands = {(row["toxic"], b) for b in row["bands"]}
        if not bands & seen:
            out.append((row["toxic"], row["place"]))
        seen |= bands
    return out


def _surprise(found: Column, rest: Column, n_found: int, n_rest: int) -> Column:
    """The likelihood ratio statistic of a term that is in so many examples of either label."""
    total, with_term = float(n_found + n_rest), found + rest

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, 2 * observed * F.ln(observed / expected)).otherwise(0.0)

    return sum((
        part(x, n * count / total)
        for n, own in ((n_found, found), (n_rest, rest))
        for x, count in ((own, with_term), (F.lit(n) - own, F.lit(total) - with_term))
    ), F.lit(0.0))


def telling_words(examples: DataFrame, n_toxic: int, n_clean: int, most: int = VOCABULARY) -> list[str]:
    """The terms that tell the labels apart more than chance lets any term do, the clearest first."""
    if not n_toxic or not n_clean:
        return []
    counted = examples.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("found"), F.sum(1 - F.col("toxic")).alias("rest")
    )
    terms = counted.count()
    least = 2 * math.log(max(terms, 1) / CHANCE)  # of a chi-squared value, exp(-x / 2) bounds the chance
    scored = counted.withColumn("surprise", _surprise(F.col("found"), F.col("rest"), n_toxic, n_clean))
    rows = scored.where(F.col("surprise") >= least).orderBy(F.desc("surprise"), "word").limit(most).collect()
    return [row["word"] for row in rows]


def document_counts(docs: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that a word is in, over all documents.

    A task sends one row per word.
    """
    wanted = {w.encode() for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(wanted.intersection(terms_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in found], pa.string()), pa.array(found.values(), pa.int64())], ["word", "docs"]
        )

    texts = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    sums = texts.mapInArrow(run, "word string, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    return docs.count(), {row["word"]: row["docs"] for row in sums.collect()}


def fitted_steps(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: ``(starts, shares)`` of a step function that does not fall."""
    distinct, at = np.unique(values, return_inverse=True)
    whole, ones = np.bincount(at, weights), np.bincount(at, weights * labels)
    blocks: list[list[float]] = []  # start, weight, weight of label 1
    for value, weight, one in zip(distinct, whole, ones, strict=True):
        blocks.append([value, weight, one])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, weight, one = blocks.pop()
            blocks[-1][1] += weight
            blocks[-1][2] += one
    return np.array([b[0] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


class ToxicityModel:
    """An index of examples, and what their votes are worth."""

    def __init__(self, words: list[str], idf: list[float], examples: list[Example], weights: tuple[float, float],
                 calibration: list[Example], default: float):
        self.place = {w.encode(): i for i, w in enumerate(words)}
        self.words, self.idf, self.default = words, np.asarray(idf, float), default
        self.label_weights = np.asarray(weights, float)
        # Alike examples side by side, so that a block's largest weights are near to those of each.
        own = sorted((e for e in examples if e.terms), key=self._heaviest)
        self.labels = np.array([e.toxic for e in own], np.int64)
        self.ids = [e.doc_id for e in own]
        self.index = BlockMaxIndex([(e.terms, self._weighed(e.terms, e.counts)) for e in own], len(words))
        self.starts, self.shares = np.empty(0), np.empty(0)
        votes = [self._vote(e.terms, e.counts)[0] if e.terms else None for e in calibration]
        labels = np.array([e.toxic for e in calibration], np.int64)
        lone = np.array([v is None for v in votes], bool)
        weight = self.label_weights[labels] if len(labels) else np.empty(0)
        if lone.any():  # what no neighbour is known of
            self.default = float((weight * labels)[lone].sum() / weight[lone].sum())
        if (~lone).any():
            near = np.array([v for v in votes if v is not None], float)
            self.starts, self.shares = fitted_steps(near, labels[~lone], weight[~lone])

    def _weighed(self, terms: list[int], counts: list[int]) -> np.ndarray:
        return (1 + np.log(counts)) * self.idf[terms]

    def _heaviest(self, example: Example) -> list[int]:
        """The terms by falling weight."""
        order = np.argsort(-self._weighed(example.terms, example.counts), kind="stable")
        return [example.terms[i] for i in order]

    def _vote(self, terms: list[int], counts: list[int]) -> tuple[float | None, list[tuple]]:
        """The share of label 1 among the neighbours, by nearness, and the nearest of them."""
        found, near = self.index.nearest(terms, self._weighed(terms, counts), NEIGHBOURS)
        if not len(found):
            return None, []
        labels = self.labels[found]
        weights = self.label_weights[labels] / (NEAR + 1 - near)
        named = [(self.ids[i], float(s), int(y)) for i, s, y in zip(found[:NAMED], near, labels)]
        return float(weights @ labels / weights.sum()), named

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, list[tuple]]:
        vote, named = self._vote(terms, counts) if terms else (None, [])
        if vote is None:
            return self.default, named
        if not len(self.starts):
            return vote, named
        at = max(int(np.searchsorted(self.starts, vote, "right")) - 1, 0)
        return float(self.shares[at]), named

    def vector(self, text: bytes | None) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The terms of the vocabulary in a text, and how often they are there."""
        words = terms_of(text) if text else []
        found = sorted(self.place[w] for w in set(words).intersection(self.place))
        counts = Counter(filter(self.place.__contains__, words)) if found else {}
        return tuple(found), tuple(counts[self.words[i].encode()] for i in found)


def learn_toxicity(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> ToxicityModel:
    """A model from up to ``most`` distinct labelled texts of either label, near copies once.

    Texts come by a hash of the text. Vectors hold the terms that tell the labels apart; their
    document frequencies are counted over all documents. The driver gets the examples' vectors
    over these terms, bounded by ``EXAMPLES`` and ``VOCABULARY``. Documents whose crc32 leaves 2
    are not learned from.
    """
    docs = docs.select("doc_id", "text")
    labelled = store(labelled_texts(docs, labels), "toxicity-labelled")
    totals = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = store(_sampled(labelled, most), "toxicity-sample")
    described = store(_examples(docs, sample), "toxicity-examples")
    kept = _independent(described.select("toxic", "place", "bands").collect())
    calibrates = {key: i % CALIBRATES == CALIBRATES - 1 for i, key in enumerate(kept)}
    spark = docs.sparkSession
    parts = spark.createDataFrame([(*k, c) for k, c in calibrates.items()], "toxic int, place long, calibrates boolean")
    examples = described.join(F.broadcast(parts), ["toxic", "place"])
    learned = examples.where(~F.col("calibrates"))
    sizes = Counter(toxic for (toxic, _), c in calibrates.items() if not c)
    words = telling_words(learned, sizes[1], sizes[0])
    n_docs, in_docs = document_counts(docs, words) if words else (0, {})
    idf = [math.log((1 + n_docs) / (1 + in_docs.get(w, 0))) + 1 for w in words]
    place = {w: i for i, w in enumerate(words)}
    vectors: dict[tuple, dict[int, int]] = {key: {} for key in kept}
    if words:
        wanted = F.broadcast(spark.createDataFrame([(w,) for w in words], "word string"))
        pairs = examples.select("toxic", "place", F.explode(F.arrays_zip("words", "counts")).alias("pair"))
        pairs = pairs.select("toxic", "place", F.col("pair.words").alias("word"), F.col("pair.counts").alias("count"))
        for row in pairs.join(wanted, "word").collect():
            vectors[row["toxic"], row["place"]][place[row["word"]]] = row["count"]
    ids = {(row["toxic"], row["place"]): row["doc_id"] for row in sample.collect()}
    made: dict[bool, list[Example]] = {False: [], True: []}
    for key in kept:
        terms = sorted(vectors[key])
        made[calibrates[key]].append(Example(ids[key], key[0], terms, [vectors[key][t] for t in terms]))
    weights = tuple(totals.get(label, 0) / max(sum(k[0] == label for k in kept), 1) for label in (0, 1))
    default = totals.get(1, 0) / sum(totals.values()) if totals else 0.0
    return ToxicityModel(words, idf, made[False], weights, made[True], default)


# --- what is scored ----------------------------------------------------------------------


def _scorer(model: ToxicityModel):
    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        known: dict[tuple, tuple[float, list[tuple]]] = {}
        for texts in batches:
            scores, evidence, words = [], [], []
            for text in texts:
                vector = model.vector(text)
                if vector not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[vector] = model.score(*map(list, vector))
                score, named = known[vector]
                scores.append(score)
                evidence.append([dict(zip(("example", "similarity", "toxic"), n, strict=True)) for n in named])
                words.append([model.words[i] for i in vector[0]])
            yield [scores, [int(s >= TOXIC_FROM) for s in scores], evidence, words]

    return work


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """``(doc, score, predicted, evidence, words)``, one row per document row.

    ``doc`` holds the columns ``keep`` of ``docs`` (all, if None); only ``text`` is looked at. A text
    is a vector of the terms that tell the labels apart, weighed by TF-IDF. Its nearest
    examples by cosine vote, by nearness; ``score`` is the share of toxic documents among
    those with such votes, and ``predicted`` is 1 from ``TOXIC_FROM`` on. ``evidence`` names the
    nearest examples (a document with the text, its cosine and label), ``words`` the terms found.

    A text that is null, empty, or without any of the terms has no neighbour: its score is the
    share of toxic documents among such examples, or among all labelled texts if there is none, or 0
    without labels. Equally near examples count in the order of their heaviest terms, then by the hash of their text. Repeated documents
    get equal rows; very long texts count whole. Other columns have no influence. No document,
    no row. Rows are streamed and nothing is shuffled.
    """
    kind = f"score double, predicted int, evidence {_EVIDENCE}, words array<string>"
    return map_texts(docs, kind, _scorer(model), keep)

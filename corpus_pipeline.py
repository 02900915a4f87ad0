"""From raw documents to a training mix: five stages, each over all that the one before kept.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet and read
again as the next one's documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import drop_stored, store, table
from tickloom.llm.decontamination import find_contamination
from tickloom.llm.language_id import (
    UNDETERMINED,
    identify_languages,
    learn_languages,
    training_sample,
)
from tickloom.llm.mixing import mix_sources
from tickloom.llm.ngram_join import similar_documents
from tickloom.llm.pii import find_pii, learn_pii, redacted

# A document goes if its most probable language is hardly more probable than chance makes it: by
# less than this share of what is left above 1 / languages (0.3 with four languages).
ABOVE_CHANCE = 1 / 15
# Near copies share so much of their shingles of so many words: 4 of 5 at least.
COPY_WORDS, COPY_ALIKE = 5, (4, 5)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def least_score(languages: int) -> float:
    """The largest of n mean probabilities is 1 / n at least, so what is unclear depends on n."""
    chance = 1 / max(languages, 1)
    return chance + ABOVE_CHANCE * (1 - chance)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no clear language, go.

    That takes null and empty texts, and all documents if none has a language to learn from.
    Rows are judged each by its text alone: repeated rows, null ids and equal ids change
    nothing, very long texts count whole, other columns come along.
    """
    model = learn_languages(training_sample(docs))
    found = identify_languages(docs, model)
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score(len(model.languages)))
    return found.where(known).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id stays, once.

    A row is known by its doc_id and text together: different texts with one doc_id, or without
    any, are rows of their own, and equal rows are one. Of equal ids the text with the smaller
    hash stays. Null and empty texts, and texts without words, are in no group and stay, once per
    doc_id. Very long texts count whole, other columns have no influence, no document gives none.
    """
    row = F.xxhash64(docs["doc_id"], docs["text"])
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), row.alias("row"))
    texts = rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))
    groups = similar_documents(texts, COPY_WORDS, COPY_ALIKE).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", F.col("doc.doc_id").alias("doc_id")).distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = groups.distinct().join(ids, "row").groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.dropDuplicates(["row"]).join(first.select("first.row"), "row", "left_semi").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages contaminate go.

    Null and empty texts hold no passage and stay; rows are judged each by its text alone, so
    repeated rows, null ids and equal ids change nothing. Very long texts are searched whole.
    Without benchmark items every document stays. Other columns come along.
    """
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select("doc.*")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes ``[KIND]``; ``n_chars`` follows the text.

    No row goes: null texts stay null, empty ones empty, repeated rows are redacted alike, whatever
    their ids. Very long texts are read whole. Other columns come along unchanged.
    """
    found = find_pii(docs, learn_pii(docs))
    text = redacted(F.col("doc.text"), F.col("spans"))
    return found.withColumn("clean", text).select(
        *[
            F.col("clean").alias("text") if c == "text"
            else F.length("clean").cast("long").alias(c) if c == "n_chars"
            else F.col(f"doc.{c}").alias(c)
            for c in docs.columns
        ]
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per document with a word taken, and how many words.

    Null and empty texts have no word and no row. A null source is a source, the last. Repeated
    rows and null ids count each; of equal draws the smaller doc_id comes first. Columns other
    than ``doc_id``, ``text`` and ``source`` have no influence; without documents there is no row.
    """
    taken = mix_sources(docs, table(spark, sf_dir, "labels")).where("taken > 0")
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_pii),
    ("mixing sources to target weights", mix),
]

# Trained networks and trees are no SQL; the tests hold each stage against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix; what a stage has stored goes when the next one is done."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before:
            drop_stored(before)
        before = docs
    return docs

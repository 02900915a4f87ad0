"""The corpus operators as queries over the tables of one input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.chat import format_conversations
from tickloom.llm.chunk_dedup import repeated_spans
from tickloom.llm.common import table
from tickloom.llm.decontamination import find_contamination
from tickloom.llm.divergence import divergence_audit
from tickloom.llm.fingerprints import fingerprint_edits
from tickloom.llm.language_id import held_out, identify_languages, learn_languages, training_sample
from tickloom.llm.mixing import mix_sources
from tickloom.llm.ngram_join import similar_documents
from tickloom.llm.pii import KINDS, count_of, find_pii, learn_pii, written
from tickloom.llm.token_counts import count_tokens, read_vocabulary
from tickloom.llm.toxicity import learn_toxicity, score_toxicity
from tickloom.llm.url_filter import judge_urls
from tickloom.llm.whitening import whiten_embeddings

Query = Callable[[SparkSession, str], DataFrame]

# A public byte-level vocabulary; installed beside the interpreter, not part of this library.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    events = format_conversations(table(spark, folder, "conversations"))
    return events.withColumn("errors", F.array_join("errors", ", "))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(table(spark, folder, "documents")).drop("edited_text")


def op3_token_counts(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), read_vocabulary(vocabulary), ["doc_id"])
    return counted.select("doc.doc_id", "n_words", "n_tokens")


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn_languages(training_sample(docs))
    found = identify_languages(docs, model, ["doc_id"])
    return found.select(
        "doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score", "positions"
    )


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return mix_sources(docs, labels).select("doc_id", "size", "source_size", "target", "taken")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_pii(docs, learn_pii(docs))
    return found.select(
        "doc.doc_id", *[count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = find_contamination(docs, benchmark, keep=["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_audit(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten_embeddings(table(spark, folder, "embeddings"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = score_toxicity(docs, learn_toxicity(docs, table(spark, folder, "labels")), ["doc_id"])
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")


def registry() -> dict[str, Query]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_fingerprints": op2_fingerprints,
        "op3_token_counts": op3_token_counts,
        "op4_chunk_dedup": op4_chunk_dedup,
        "op5_language_id": op5_language_id,
        "op6_mix_sources": op6_mix_sources,
        "op7_pii": op7_pii,
        "op8_ngram_join": op8_ngram_join,
        "op9_url_filter": op9_url_filter,
        "op10_decontamination": op10_decontamination,
        "op11_source_divergence": op11_source_divergence,
        "op12_whitening": op12_whitening,
        "op13_toxicity": op13_toxicity,
    }

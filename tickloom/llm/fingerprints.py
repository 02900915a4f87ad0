"""Document fingerprints: Merkle trees over sections, paragraphs and phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import let

# A section ends after its blank lines, a paragraph after its line break, a phrase after its
# sentence or after eight words. All pieces keep their white space: together they are the text.
_SECTIONS = r"(?<=\n\n)(?!\n)"
_PARAGRAPHS = r"(?<=\n)"
_PHRASES = r"(?:(?!\S*[.!?]\s)\S++\s*+){0,7}\S++\s*+|\s++"
_LEAF = 8  # hex digits of a phrase's digest that the fingerprint holds
_ROOT = 64

# Documents of neighbouring ids that are put in order together.
BUCKET_ROWS, MOST_BUCKETS = 20_000, 16_384


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def fingerprint(text: Column) -> Column:
    """The tree of a text as ``root:sections``; null counts as empty.

    The root is a SHA-256 over its sections' digests, those over their paragraphs', those over
    their phrases': equal roots mean equal texts. After the root stand the phrases' digests
    (8 hex digits each), ``.`` between paragraphs, ``/`` between sections, so that two
    fingerprints show which branches differ.
    """
    tree = F.transform(
        F.split(F.coalesce(text, F.lit("")), _SECTIONS),
        lambda section: F.transform(
            F.split(section, _PARAGRAPHS),
            lambda paragraph: F.transform(
                F.regexp_extract_all(paragraph, F.lit(_PHRASES), F.lit(0)), lambda x: F.sha2(x, 256)
            ),
        ),
    )

    def written(tree: Column) -> Column:
        root = _digest(F.transform(tree, lambda s: _digest(F.transform(s, _digest))))
        sections = F.transform(tree, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(
            F.transform(p, lambda d: F.substring(d, 1, _LEAF)), ""
        )), "."))
        return F.concat_ws(":", root, F.array_join(sections, "/"))

    return let(tree, written)


def _leaves(print_: Column) -> Column:
    return F.array_distinct(
        F.regexp_extract_all(F.substring(print_, _ROOT + 2, 1 << 30), F.lit(f"[0-9a-f]{{{_LEAF}}}"), F.lit(0))
    )


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the share of phrases that both have (Dice, 0 to 1)."""

    def dice(both: Column) -> Column:
        left, right = both["left"], both["right"]
        all_ = F.size(left) + F.size(right)
        shared = F.size(F.array_intersect(left, right))
        return F.when(all_ > 0, 2.0 * shared / all_).otherwise(F.lit(0.0))

    compared = let(F.struct(_leaves(a).alias("left"), _leaves(b).alias("right")), dice)
    return F.when(a == b, F.lit(1.0)).otherwise(compared)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """``array<struct<section, paragraph>>`` (from 0): the branches whose digests differ.

    Empty for equal roots; otherwise only branches that differ are walked down.
    """

    def below(x: Column) -> Column:
        left = F.split(F.coalesce(x["left"], F.lit("")), r"\.")
        right = F.split(F.coalesce(x["right"], F.lit("")), r"\.")
        pairs = F.arrays_zip(left.alias("left"), right.alias("right"))
        marked = F.transform(pairs, lambda p, i: F.struct(
            x["section"].alias("section"), i.alias("paragraph"), p["left"].eqNullSafe(p["right"]).alias("same")
        ))
        return F.filter(marked, lambda p: ~p["same"])

    sections = F.arrays_zip(
        F.split(F.substring(a, _ROOT + 2, 1 << 30), "/").alias("left"),
        F.split(F.substring(b, _ROOT + 2, 1 << 30), "/").alias("right"),
    )
    numbered = F.transform(sections, lambda s, i: F.struct(
        i.alias("section"), s["left"].alias("left"), s["right"].alias("right")
    ))
    differ = F.filter(numbered, lambda s: ~s["left"].eqNullSafe(s["right"]))
    found = F.transform(F.flatten(F.transform(differ, below)), lambda p: F.struct(p["section"], p["paragraph"]))
    return F.when(F.substring(a, 1, _ROOT) == F.substring(b, 1, _ROOT), F.slice(found, 1, 0)).otherwise(found)


def _first_ids(docs: DataFrame, bucket_rows: int) -> list[int]:
    """Ids that cut the order of all ids into buckets of about ``bucket_rows`` rows.

    Every id in the list exists, and no other lies in front of it in its bucket. The list is
    short (``MOST_BUCKETS``); only ids are read.
    """
    spark = docs.sparkSession
    ids = docs.where("doc_id is not null").select("doc_id")
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(MOST_BUCKETS, max(least, ids.count() // bucket_rows))
    shares = [i / n for i in range(1, n)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 20 * n)).first()[0] or []))
    placed = ids.select("doc_id", _bucket(F.col("doc_id"), cuts).alias("bucket"))
    firsts = placed.groupBy("bucket").agg(F.min("doc_id").alias("first"))
    return sorted(r["first"] for r in firsts.collect())


def _bucket(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are not above the id, by binary search; 0 for a null id."""
    if not cuts:
        return F.lit(0)
    steps = [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    known = F.lit(cuts).cast("array<bigint>")
    return F.aggregate(
        F.lit(steps), F.lit(0),
        lambda at, step: F.when(F.get(known, at + step - 1) <= doc_id, at + step).otherwise(at),
    )


def with_next_text(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, text, ghost, ...)`` in buckets: each row's successor stands in its own bucket.

    The first row of a bucket is also put into the bucket before it as a ghost, and the
    first row of all into the last one. See ``successor_window`` for the order.
    """
    cuts = _first_ids(docs, bucket_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    nulls = not docs.where("doc_id is null").isEmpty()
    is_first = F.col("doc_id").isNull() if nulls else (
        F.coalesce(F.col("doc_id") == F.lit(cuts[0] if cuts else None).cast("bigint"), F.lit(False))
    )
    starts = F.col("bucket") > 0
    if cuts:
        starts &= F.get(F.lit(cuts).cast("array<bigint>"), F.col("bucket") - 1) == F.col("doc_id")
    placed = rows.withColumn("bucket", _bucket(F.col("doc_id"), cuts))

    def place(bucket: Column, ghost: bool, wrapped: bool) -> Column:
        return F.struct(bucket.alias("bucket"), F.lit(ghost).alias("ghost"), F.lit(wrapped).alias("wrapped"))

    places = F.array(
        place(F.col("bucket"), False, False),
        F.when(starts, place(F.col("bucket") - 1, True, False)),
        F.when(is_first, place(F.lit(len(cuts)), True, True)),
    )
    return placed.select("doc_id", "text", F.inline(F.filter(places, lambda p: p.isNotNull())))


def successor_window() -> Window:
    """Ascending doc_id (null first), rows of one id by their text; the first follows the last."""
    return Window.partitionBy("bucket").orderBy("wrapped", F.col("doc_id").asc_nulls_first(), "text")


def fingerprint_edits(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of documents and of their edited texts, one row per row of ``docs``.

    The edited text has its last ``floor(n_chars / 4)`` code points replaced by the first as many
    (or all) of the next document's, in ascending doc_id; the first follows the last. Columns:
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    and ``edited_text``.

    Null texts count as empty; an empty text stays empty and is equal to its edit. A single
    document follows itself. Null ids come first; rows of one id follow each other in the
    order of their texts. Other columns are left out. No document, no row.

    The texts are shuffled once, by bucket of neighbouring ids; the second window reuses that
    order. Buckets follow the distribution of the ids, so their size does not depend on gaps.
    """
    after = successor_window()
    rows = with_next_text(docs, bucket_rows).withColumn("next_text", F.lead("text").over(after))
    n_chars = F.length("text")
    edit = F.floor(n_chars / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n_chars - edit),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), edit),
    )
    printed = rows.select(
        "doc_id", "text", "bucket", "ghost", "wrapped", n_chars.cast("long").alias("n_chars"),
        F.when(~F.col("ghost"), edited).alias("edited_text"), fingerprint(F.col("text")).alias("fingerprint"),
    ).withColumn("next_print", F.lead("fingerprint").over(after))
    kept = printed.where(~F.col("ghost")).withColumn("edited_fingerprint", fingerprint(F.col("edited_text")))
    return kept.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"), "edited_text",
    )

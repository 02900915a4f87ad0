"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, store

# No document is taken more often than this.
MOST_EPOCHS = 3
# Sampling weight of documents that a reader labelled good, bad, or not at all.
GOOD, BAD, UNLABELLED = 2.0, 0.5, 1.0
SEED = "mix-1"
# Rows of the table that share one step of the key range, on average, and fewest steps.
STEP_ROWS, LEAST_STEPS = 50_000, 256


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """An exponential variate with rate ``weight``: the smaller, the earlier it is drawn.

    It depends on the seed, the id and the weight alone, so a rerun draws the same.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((number + 0.5) / 4503599627370496.0) / weight


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the whole size; a
    target stops at three times its source's size and the excess goes to the others by weight.
    That limit is reached at one level: with sources in order of cap per weight, the first
    that the level before it does not fill sets the level of all others. The input has one
    row per source, so the one window without a partition stays as small as that list.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "cap", F.col("source_size") * MOST_EPOCHS
    )
    by_fill = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left_words = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = weighed.withColumn("place", F.row_number().over(by_fill)).withColumn(
        "level", left_words.cast("double") / left_weight.cast("double")
    )
    open_place = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("place"))
    level = F.min(F.when(open_place.isNotNull(), F.struct(open_place.alias("p"), "level"))).over(whole)
    return filled.select(
        "source", "source_size",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("weight") * level["level"]),
            F.col("cap").cast("double"),
        ).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    labels: DataFrame | None = None,
    seed: str = SEED,
    step_rows: int = STEP_ROWS,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, epochs, taken)``, one row per document row.

    Whole epochs come first: each document is taken ``floor(target / source_size)`` times.
    What is then missing to the target is drawn from the source by exponential keys scaled
    with quality weights (``labels``: ``doc_id, quality``; the best label of an id counts); the
    draw's last document gives only the words still missing, so a source's taken words are
    its target rounded down. ``taken`` counts words, repeats included.

    Null text has no words and is taken 0 times; a null source is a source of its own; a null
    doc_id is drawn like any other id. Ties of the key go by doc_id (null first), then by size:
    rows equal in all three are exchangeable. Other columns are left out. No document, no row.

    Nothing sorts a whole source. The key range is cut into steps of about ``step_rows`` rows;
    sizes are summed per source and step, running totals over those sums find the one step
    where the draw ends, and only the rows of that step are put in order.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    weight = F.lit(UNLABELLED)
    if labels is not None:
        best = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
            F.max("quality").alias("quality")
        )
        sized = sized.join(best, F.col("doc_id") == F.col("label_id"), "left")
        weight = (
            F.when(F.col("quality") > 0, F.lit(GOOD)).when(F.col("quality") <= 0, F.lit(BAD))
            .otherwise(weight)
        )
    keyed = store(
        sized.select("doc_id", "source", "size", sampling_key(F.col("doc_id"), weight, seed).alias("key")),
        "mix-sizes",
    )
    steps = max(LEAST_STEPS, keyed.count() // step_rows)
    keyed = keyed.withColumn("step", F.floor((1 - F.exp(-F.col("key"))) * steps))

    sums = store(
        keyed.groupBy("source", "step").agg(F.sum("size").alias("step_size")), "mix-steps"
    )
    targets = source_targets(sums.groupBy("source").agg(F.sum("step_size").alias("source_size")))
    plans = targets.select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("epochs"),
    ).withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("step")
    upto = sums.select("source", "step", "step_size", F.sum("step_size").over(running).alias("upto"))
    last = (
        upto.join(plans.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where("upto > rest")
        .groupBy("source")
        .agg(F.min(F.struct("step", (F.col("upto") - F.col("step_size")).alias("drawn"))).alias("last"))
        .select(F.col("source").alias("s"), "last.step", "last.drawn")
    )
    plans = store(
        plans.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.struct("source").alias("plan_source"), "source_size", "target", "epochs", "rest",
            F.col("step").alias("last_step"), "drawn",
        ),
        "mix-plans",
    )

    planned = keyed.join(plans, F.struct("source") == F.col("plan_source"))
    at_end = F.coalesce(F.col("step") == F.col("last_step"), F.lit(False))
    in_order = (
        Window.partitionBy("source", "step").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = planned.where(at_end).withColumn(
        "drawn_before", F.col("drawn") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    )
    drawn = F.greatest(F.least(F.col("rest") - F.col("drawn_before"), F.col("size")), F.lit(0))
    whole = F.when(F.col("step") < F.col("last_step"), F.col("size")).otherwise(0)
    columns = ["doc_id", "source", "size", "source_size", "target", "epochs"]
    return ordered.select(*columns, (F.col("epochs") * F.col("size") + drawn).alias("taken")).union(
        planned.where(~at_end).select(
            *columns, (F.col("epochs") * F.col("size") + whole).alias("taken")
        )
    )

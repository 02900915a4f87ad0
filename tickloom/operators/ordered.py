"""Order-dependent operators that hold up when one key owns a large share of the rows.

A plain window function sends all rows of a key to one task. The operators here first
reduce each key with mergeable aggregates and only ever order what is bounded: one
newest row per key, one row per key and day, or one row per distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.risk import utc_date
from tickloom.session import store


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` columns per key; ties go to the greatest rest.

    Spark keeps one row per key in each task before the shuffle (a window group limit), so a
    key with many copies stays small.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*newest, *rest)])
    numbered = df.withColumn("_newest", F.row_number().over(order))
    return numbered.filter(F.col("_newest") == 1).drop("_newest")


def running_max(
    df: DataFrame, key: str, order: str, value: str, out: str, block: Column | None = None
) -> DataFrame:
    """Running maximum of ``value`` per ``key`` in ``order``, current row included.

    Rows are ordered inside (key, block) only, a block being one UTC day unless given.
    What earlier blocks contribute is one number per block, carried over by a window on
    the per-block maxima.
    """
    block = utc_date(F.col(order)) if block is None else block
    blocked = df.withColumn("_block", block)
    history = Window.partitionBy(key).orderBy("_block")
    carried = (
        blocked.groupBy(key, "_block")
        .agg(F.max(value).alias("_block_max"))
        .select(
            key,
            "_block",
            F.max("_block_max")
            .over(history.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_carried"),
        )
    )
    inside = Window.partitionBy(key, "_block").orderBy(order)
    return (
        blocked.withColumn(
            "_inside", F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        )
        .join(carried, [key, "_block"], "left")
        .withColumn(out, F.greatest("_inside", "_carried"))
        .select(*df.columns, out)
    )


def _step(value: Column) -> Column:
    """A coarse, order-preserving step of a value: 16 steps per doubling, one for the rest."""
    lowest = F.lit(-(1 << 20))
    beyond = F.isnan(value) | (value == float("inf"))
    step = F.when(beyond, F.lit(1 << 20)).when(value > 0, F.floor(F.log2(value) * 16).cast("int"))
    return F.coalesce(step, lowest)


def rank_desc(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """SQL ``rank()`` of a non-negative ``value``, greatest first and nulls last, in ``group``.

    Ties are counted before anything is ordered, so the ordered table has one row per
    distinct value. It is ordered in steps of the value range, and each step starts from
    the count of all higher steps. ``df`` is read twice and must be stored, so that both
    reads see the same values.
    """
    keyed = df.withColumn("_value", F.coalesce(F.col(value), F.lit(-1.0)))
    tallies = (
        keyed.groupBy(group, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_step", _step(F.col("_value")))
    )
    steps_down = Window.partitionBy(group).orderBy(F.desc("_step"))
    above = (
        tallies.groupBy(group, "_step")
        .agg(F.sum("_n").alias("_n"))
        .select(
            group,
            "_step",
            F.coalesce(
                F.sum("_n").over(steps_down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_above"),
        )
    )
    in_step = Window.partitionBy(group, "_step").orderBy(F.desc("_value"))
    ranks = (
        tallies.withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(in_step.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .join(above, [group, "_step"])
        .select(group, "_value", (F.col("_above") + F.col("_before") + 1).alias(out))
    )
    return keyed.join(ranks, [group, "_value"], "left").select(*df.columns, out)


def newest_n_per_key(df: DataFrame, key: str, newest: Sequence[str], n: int, out: str) -> DataFrame:
    """The ``n`` newest rows per key, numbered from 1; each task keeps ``n`` before the shuffle."""
    recent = Window.partitionBy(key).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn(out, F.row_number().over(recent)).filter(F.col(out) <= n)


def positions(df: DataFrame, order: Sequence[tuple[str, bool]], out: str) -> DataFrame:
    """``df`` with the place of each row in a global order, from 1; ``order`` is (column, descending).

    Ties go by the remaining columns. Rows are dealt out by ranges of the order and stored; a row's
    place is its number within its range and the rows of all ranges before. What one task
    orders is a range, or one number per range. Nulls come first upwards and last downwards.
    """
    rest = [(c, False) for c in df.columns if c not in dict(order)]
    keys = [F.desc(c) if down else F.asc(c) for c, down in (*order, *rest)]
    ranged = store(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "positions")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*keys)
    numbered = ranged.withColumn("_number", F.row_number().over(inside)).join(offsets, "_range")
    return numbered.withColumn(out, F.col("_before") + F.col("_number")).select(*df.columns, out)

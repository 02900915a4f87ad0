"""Exact percentiles from quantile sketches that are kept, merged and narrowed."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import store

# Size of a sketch.
SKETCH_SIZE = 1024
# Rows of a bracket that one array takes.
GATHERED = 8192
_GROUP = "_group"
_CUTS = ("from", "mid", "to")
# Steps of the shares that the sketch of a bracket is asked for.
_SHARES = 64


def _values(df: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    known = df.select(*keys, F.col(value).cast("double").alias("_v"))
    return known.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def value_sketches(
    df: DataFrame, keys: Sequence[str | Column], value: str, size: int = SKETCH_SIZE
) -> DataFrame:
    """Per key: ``n``, ``low``, ``high`` and a mergeable quantile ``sketch`` of the values.

    Nulls and NaN are no values; a key without values has no row. Kept per symbol and day,
    a day's sketches are written anew when its rows change, and the other days' stand.
    """
    rows = _values(df, keys, value)
    names = [c for c in rows.columns if c != "_v"]
    return rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_v").alias("low"),
        F.max("_v").alias("high"),
        F.kll_sketch_agg_double("_v", size).alias("sketch"),
    )


def merge_sketches(sketches: DataFrame, by: str) -> DataFrame:
    """The sketches of finer keys (days) as one per ``by``."""
    return sketches.groupBy(by).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _error(size: int) -> float:
    """Rank error that a sketch of ``size`` rarely exceeds, with room; a miss costs a further pass."""
    return 3.0 / size**0.9


def _targets(merged: DataFrame, ps: Sequence[float], size: int) -> DataFrame:
    """One row per group and wanted rank: its bracket (the whole group), and three cuts into it."""
    top, wide = F.col("_n") - 1, _error(size)
    shares = [min(1.0, max(0.0, p / 100.0 + d)) for p in ps for d in (-wide, 0.0, wide)]
    drawn = merged.withColumn("_q", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares))))
    wanted = [
        F.struct(f(F.lit(p / 100.0) * top).cast("long").alias("rank"), *[
            F.get("_q", F.lit(3 * i + j)).alias(c) for j, c in enumerate(_CUTS)
        ])
        for i, p in enumerate(ps) for f in (F.floor, F.ceil)
    ]
    each = drawn.select(_GROUP, "_n", "low", "high", F.explode(F.array(*wanted)).alias("t"))
    return each.select(
        _GROUP, "_n", "t.rank", F.lit(0).cast("long").alias("below"), F.col("low").alias("lo"), F.col("high").alias("hi"),
        F.col("_n").alias("inside"), *[f"t.{c}" for c in _CUTS],
    ).dropDuplicates([_GROUP, "_n", "rank"])


def _cut(narrowed: DataFrame, size: int) -> DataFrame:
    """Cuts into new brackets, from their own sketches; those without one are cut at their lowest value."""
    wide = math.ceil(_error(size) * _SHARES) + 1
    shares = F.array(*[F.lit(i / _SHARES) for i in range(_SHARES + 1)])
    large = F.col("sketch").isNotNull() & (F.col("inside") > GATHERED)
    drawn = narrowed.withColumn("_q", F.when(large, F.kll_sketch_get_quantile_double("sketch", shares)))
    at = F.round((F.col("rank") - F.col("below") + 0.5) / F.col("inside") * _SHARES).cast("int")

    def cut(steps: int, otherwise: str) -> Column:
        place = F.greatest(F.lit(0), F.least(F.lit(_SHARES), at + steps))
        return F.coalesce(F.get("_q", place), F.col(otherwise))

    return drawn.select(
        _GROUP, "_n", "rank", "below", "lo", "hi", "inside",
        cut(-wide, "lo").alias("from"), cut(0, "lo").alias("mid"), cut(wide, "hi").alias("to"),
    )


def narrowing_pass(rows: DataFrame, targets: DataFrame, wanted: int, size: int) -> DataFrame:
    """The cells that the targets' bracket ends and cuts make of their groups: count, ends, sketch.

    A cell is one such value, or what lies between two. Each task leaves a few dozen cells per
    group, so no group is gathered or put in order. Grouping by the targets' own key puts a
    shuffle between a sort-merge join and the aggregation, without which Spark could not split
    a group that holds most of the rows.
    """
    names = ("lo", "hi", *_CUTS)
    ends = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(*names)))))
    asked = targets.groupBy(F.col(_GROUP).alias("_asked"), "_n").agg(ends.alias("_ends"))
    places = range(len(names) * wanted)
    asked = asked.select("_asked", "_n", *[F.get("_ends", F.lit(i)).alias(f"_e{i}") for i in places])
    v = F.col("_v")
    steps = [F.when(v > e, 2).when(v == e, 1).otherwise(0) for e in (F.col(f"_e{i}") for i in places)]
    met = rows.join(asked, F.col(_GROUP).eqNullSafe(F.col("_asked")))
    cells = met.select("_asked", "_n", "_v", reduce(Column.__add__, steps).alias("cell"))
    return cells.groupBy("_asked", "_n", "cell").agg(
        F.count(F.lit(1)).alias("inside"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
        F.kll_sketch_agg_double("_v", size).alias("sketch"),
    )


def _narrowed(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with the cell that holds its rank as the new bracket; null if none does."""
    upward = Window.partitionBy("_asked", "_n").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("below", F.coalesce(F.sum("inside").over(upward), F.lit(0)))
    asked = targets.select(_GROUP, F.col("_n").alias("_size"), "rank")
    holds = (
        F.col(_GROUP).eqNullSafe(F.col("_asked")) & (F.col("rank") >= F.col("below"))
        & (F.col("rank") < F.col("below") + F.col("inside"))
    )
    return asked.join(placed, holds, "left").select(
        _GROUP, F.col("_size").alias("_n"), "rank", "below", "lo", "hi", "inside", "sketch"
    )


def gathered(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The values of ranks whose brackets hold at most ``GATHERED`` rows, which one array takes.

    Brackets of a group are equal or apart, so a row falls into one at most.
    """
    brackets = targets.groupBy(F.col(_GROUP).alias("_asked"), "_n", "lo", "hi", "below").agg(
        F.collect_list("rank").alias("ranks")
    )
    held = F.col(_GROUP).eqNullSafe(F.col("_asked")) & F.col("_v").between(F.col("lo"), F.col("hi"))
    lists = rows.join(brackets, held).groupBy("_asked", "_n", "lo", "hi", "below", "ranks").agg(
        F.array_sort(F.collect_list("_v")).alias("l")
    )
    each = lists.select(F.col("_asked").alias(_GROUP), "_n", "below", "l", F.explode("ranks").alias("rank"))
    return each.select(_GROUP, "_n", "rank", F.get("l", (F.col("rank") - F.col("below")).cast("int")).alias("value"))


def exact_percentiles(
    df: DataFrame,
    sketches: DataFrame,
    by: str,
    value: str,
    ps: Sequence[float] = (50, 95, 99),
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Exact, linearly interpolated percentiles and row count per group, from kept sketches.

    ``sketches`` are ``value_sketches`` by ``by`` and any finer keys, of ``size`` at least; they are merged.
    Every wanted rank of a large group gets a bracket of values: a pass over the rows counts the
    cells around the sketch's guess and sketches them; the cell with the rank is the next bracket,
    until it holds one value or at most ``GATHERED`` rows. Those are put in order, and nothing else
    is. A guess that misses costs a pass, never the result, and repeated values become a cell of
    their own. Sketches of other rows than ``df`` holds are an error.
    """
    wanted = 2 * len(ps)
    merged = merge_sketches(sketches, by).withColumnsRenamed({by: _GROUP, "n": "_n"})
    rows = _values(df, [F.col(by).alias(_GROUP)], value)
    state = store(_targets(merged, ps, size), "percentile-targets")
    same, few = F.col("lo") == F.col("hi"), F.col("inside") <= GATHERED
    done, small = [], []
    while True:
        done.append(state.filter(same).select(_GROUP, "_n", "rank", F.col("lo").alias("value")))
        small.append(state.filter(~same & few))
        waiting = state.filter(~same & ~few)
        if waiting.isEmpty():
            break
        cells = store(narrowing_pass(rows, waiting, wanted, size), "percentile-cells")
        narrowed = store(_narrowed(cells, waiting), "percentile-brackets")
        if not narrowed.filter("inside is null").isEmpty():
            raise ValueError("the sketches are not of these rows")
        state = store(_cut(narrowed, size), "percentile-targets")
    few_rows = gathered(rows, reduce(DataFrame.unionByName, small))
    done = reduce(DataFrame.unionByName, done).unionByName(few_rows)
    found = done.groupBy(_GROUP, "_n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("m"))

    def between(p: float) -> Column:
        at = F.lit(p / 100.0) * (F.col("_n") - 1)
        lower, upper = (F.col("m")[f(at).cast("long")] for f in (F.floor, F.ceil))
        return F.when(lower == upper, lower).otherwise(lower + (upper - lower) * (at - F.floor(at)))

    return found.select(
        F.col(_GROUP).alias(by),
        F.col("_n").alias("row_count"),
        *[between(p).alias(f"p{p:g}".replace(".", "_")) for p in ps],
    )

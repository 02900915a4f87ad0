"""Figures behind the dashboard: totals, ticker strip, midpoint series, percentiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import newest_n_per_key

# Number of points per symbol in the chart.
SERIES_POINTS = 12


def kpi_totals(summary: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of totals over both marts, added up in a single aggregation."""
    from_summary = summary.select(
        F.col("total_trades"),
        F.col("total_volume"),
        F.lit(1).alias("symbols"),
        (F.col("volatility_regime") == "HIGH").cast("int").alias("high_regime"),
        (F.col("volatility_regime") == "MEDIUM").cast("int").alias("medium_regime"),
        F.lit(0).alias("active_alerts"),
    )
    from_alerts = alerts.select(F.lit(1).alias("active_alerts"))
    parts = from_summary.unionByName(from_alerts, allowMissingColumns=True)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return parts.agg(
        total("total_trades").cast("bigint").alias("total_trades"),
        F.round(total("total_volume") / 1e6, 2).alias("total_volume_millions"),
        total("symbols").alias("symbols"),
        total("high_regime").alias("high_regime"),
        total("medium_regime").alias("medium_regime"),
        total("active_alerts").alias("active_alerts"),
    )


def ticker_strip(summary: DataFrame) -> DataFrame:
    """Per symbol: price, session swing in percent of the low, and which half it trades in."""
    low, high = F.col("session_low"), F.col("session_high")
    return summary.select(
        "symbol",
        F.round("avg_vwap", 2).alias("price"),
        F.round((high - low) / F.nullif(low, F.lit(0.0)) * 100, 2).alias("change_pct"),
        F.when(F.col("avg_vwap") > (low + high) / 2, "UP").otherwise("DOWN").alias("direction"),
        "volatility_regime",
    )


def portfolio_table(summary: DataFrame) -> DataFrame:
    """The summary as listed: prices to 2 decimals, volatility to 4."""
    return summary.select(
        "symbol",
        F.round("avg_vwap", 2).alias("vwap"),
        F.round("session_low", 2).alias("session_low"),
        F.round("session_high", 2).alias("session_high"),
        F.round("avg_volatility", 4).alias("volatility"),
        "volatility_regime",
        F.round("max_drawdown_pct", 2).alias("drawdown_pct"),
        "total_trades",
    )


def alerts_feed(alerts: DataFrame) -> DataFrame:
    """Alerts as listed, with a readable label and colour."""
    return alerts.select(
        "symbol",
        F.replace("alert_type", F.lit("_"), F.lit(" ")).alias("label"),
        F.when(F.col("alert_type") == "WATCH", "amber").otherwise("red").alias("colour"),
        F.round("current_vwap", 2).alias("vwap"),
        F.round("volatility", 4).alias("volatility"),
        "volatility_rank",
        F.round("drawdown_pct", 2).alias("drawdown_pct"),
    )


def midpoint_series(facts: DataFrame, summary: DataFrame, n: int = SERIES_POINTS) -> DataFrame:
    """The last ``n`` windows of each symbol as percent from the middle of its session range.

    ``point`` counts back from the newest window (``T-0``). Cutting to ``n`` comes first, so
    the join handles a few rows per symbol.
    """
    recent = newest_n_per_key(
        facts.select("symbol", "window_end", "window_start", "vwap"),
        "symbol",
        ["window_end", "window_start"],
        n,
        out="_age",
    )
    middle = summary.select(
        "symbol", ((F.col("session_low") + F.col("session_high")) / 2).alias("_mid")
    )
    return recent.join(middle, "symbol").select(
        F.concat(F.lit("T-"), (F.col("_age") - 1).cast("string")).alias("point"),
        "symbol",
        F.round((F.col("vwap") - F.col("_mid")) / F.nullif("_mid", F.lit(0.0)) * 100, 4).alias(
            "pct_from_mid"
        ),
    )


def midpoint_wide(series: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The series with one column per listed symbol, one row per point."""
    return (
        series.groupBy("point")
        .pivot("symbol", list(symbols))
        .agg(F.first("pct_from_mid", ignorenulls=True))
    )


def value_percentiles(
    df: DataFrame,
    by: str,
    value: str,
    ps: Sequence[float] = (50, 95, 99),
    accuracy: int = 100_000,
) -> DataFrame:
    """Exact, linearly interpolated percentiles and row count per group.

    A first pass sketches each group and brackets every percentile between two values. The
    sketch's error bound says how wide a bracket must be, so the wanted rows are surely in
    it. The second pass counts the rows between brackets, and the distinct values inside
    them. Only the inside, a few parts in ``accuracy`` of a large group, is ever ordered.
    """
    known = df.select(by, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    margins = sorted({m for m in (4.0 / accuracy, 1e-3, 1e-2, 0.1) if m >= 4.0 / accuracy})
    points = sorted(
        {p / 100.0 + sign * m for p in ps for m in margins for sign in (-1, 1)}
    )
    points = [point for point in points if 0.0 < point < 1.0]
    sketch = known.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.percentile_approx("v", points or [0.5], accuracy).alias("s"),
    )

    def cut(p: float, sign: int) -> Column:
        """The bracket end of one percentile: the tightest that the error bound vouches for."""
        end = F.col("low") if sign < 0 else F.col("high")
        for m in reversed(margins):
            at = p / 100.0 + sign * m
            if at in points:
                safe = F.col("n") * (m - 1.0 / accuracy) >= 3
                end = F.when(safe, F.col("s")[points.index(at)]).otherwise(end)
        return end

    brackets = sketch.select(
        F.col(by).alias("_group"),
        "n",
        *[cut(p, -1).alias(f"from{i}") for i, p in enumerate(ps)],
        *[cut(p, 1).alias(f"to{i}") for i, p in enumerate(ps)],
    )
    # The bracket ends cut a group into cells that lie wholly inside or outside a bracket.
    v = F.col("v")
    ends = range(len(ps))
    cell = reduce(
        add,
        [(v >= F.col(f"from{i}")).cast("int") + (v > F.col(f"to{i}")).cast("int") for i in ends],
    )
    inside = reduce(or_, [v.between(F.col(f"from{i}"), F.col(f"to{i}")) for i in ends])
    # Grouping by the bracket's own key puts a shuffle between join and aggregation, without
    # which Spark could not split a group that holds most of the rows.
    tallies = (
        known.join(brackets, F.col(by).eqNullSafe(F.col("_group")), "left")
        .select("_group", "n", cell.alias("cell"), F.when(inside, v).alias("v"))
        .groupBy("_group", "n", "cell", "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upward = Window.partitionBy("_group").orderBy("cell", "v")
    ranked = tallies.withColumn(
        "upto", F.sum("c").over(upward.rowsBetween(Window.unboundedPreceding, 0))
    )

    def held(index: Column) -> Column:
        """The value at a zero-based position of the ordered group."""
        here = (F.col("upto") > index) & (F.col("upto") - F.col("c") <= index)
        return F.max(F.when(here, F.col("v")))

    positions = [F.lit(p / 100.0) * (F.col("n") - 1) for p in ps]
    found = ranked.groupBy("_group", "n").agg(
        *[held(F.floor(at)).alias(f"lower{i}") for i, at in enumerate(positions)],
        *[held(F.ceil(at)).alias(f"upper{i}") for i, at in enumerate(positions)],
    )

    def between(i: int) -> Column:
        lower, upper = F.col(f"lower{i}"), F.col(f"upper{i}")
        missed = F.raise_error(F.lit("percentile outside its bracket")).cast("double")
        exact = lower + (upper - lower) * (positions[i] - F.floor(positions[i]))
        return F.when(lower.isNull() | upper.isNull(), missed).otherwise(exact)

    names = [f"p{p:g}".replace(".", "_") for p in ps]
    return found.select(
        F.col("_group").alias(by),
        F.col("n").alias("row_count"),
        *[between(i).alias(name) for i, name in enumerate(names)],
    )

"""The risk models: staged windows, enriched facts, per-symbol summary, active alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.risk import (
    DRAWDOWN_PCT,
    DRAWDOWN_RATIO,
    WATCH_RANK,
    alert_type,
    drawdown_pct,
    drawdown_ratio,
    volatility_regime,
)
from tickloom.operators.ordered import latest_per_key, rank_desc, running_max
from tickloom.schemas import WINDOW


def stg_windows(lake: DataFrame) -> DataFrame:
    """Typed lake rows, one per symbol and window start.

    Of several fragments the one that ended last wins, then the one with more trades,
    then the higher VWAP.
    """
    typed = lake.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOW])
    return latest_per_key(
        typed, ["symbol", "window_start"], ["window_end", "trade_count", "vwap"]
    )


def vwap_facts(staged: DataFrame) -> DataFrame:
    """Staged windows with running session high, drawdown and cross-symbol volatility rank.

    The high is the running maximum of ``max_price`` up to and including each window. The
    input is read by several branches, so it should be a stored table or a view over one.
    """
    highs = running_max(staged, "symbol", "window_start", "max_price", out="session_high")
    with_drawdown = highs.withColumn(
        "drawdown_pct", drawdown_pct(F.col("session_high"), F.col("vwap"), 4)
    )
    return rank_desc(with_drawdown, "window_start", "volatility", out="volatility_rank")


def portfolio_summary(facts: DataFrame) -> DataFrame:
    """One row per symbol: session totals, extremes, and the volatility regime."""
    low, high = F.min("min_price"), F.max("max_price")
    return (
        facts.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("total_windows"),
            F.round(F.avg("vwap"), 2).alias("avg_vwap"),
            F.round(low, 2).alias("session_low"),
            F.round(high, 2).alias("session_high"),
            F.round(high - low, 2).alias("session_range"),
            F.round(F.avg("volatility"), 6).alias("avg_volatility"),
            F.round(F.max("volatility"), 6).alias("peak_volatility"),
            F.sum("trade_count").cast("bigint").alias("total_trades"),
            F.round(F.sum("total_volume"), 0).alias("total_volume"),
            F.round(F.max("drawdown_pct"), 2).alias("max_drawdown_pct"),
            F.min("window_start").alias("session_start"),
            F.max("window_end").alias("last_updated"),
        )
        .withColumn("volatility_regime", volatility_regime(F.col("avg_volatility")))
    )


def volatility_alerts(
    facts: DataFrame, threshold: float = DRAWDOWN_PCT, top: int = WATCH_RANK
) -> DataFrame:
    """Symbols whose latest window is in drawdown or among the ``top`` most volatile."""
    latest = latest_per_key(facts, ["symbol"], ["window_end", "window_start"])
    active = (F.col("drawdown_pct") > threshold) | (F.col("volatility_rank") <= top)
    return latest.filter(active).select(
        "symbol",
        F.col("window_end").alias("alert_time"),
        F.col("vwap").alias("current_vwap"),
        "session_high",
        F.round("drawdown_pct", 2).alias("drawdown_pct"),
        F.round("volatility", 6).alias("volatility"),
        "volatility_rank",
        alert_type(F.col("drawdown_pct"), F.col("volatility_rank"), threshold).alias("alert_type"),
    )


def alerts_in_order(alerts: DataFrame) -> DataFrame:
    """Alerts as served: deepest drawdown first, then most volatile, then by symbol."""
    return alerts.orderBy(F.desc_nulls_last("drawdown_pct"), F.desc("volatility"), "symbol")


def stream_highs(windows: DataFrame, threshold: float = DRAWDOWN_RATIO) -> DataFrame:
    """Batch form of the streaming drawdown check: the high is the running maximum VWAP.

    Alert columns are filled only where the unrounded drawdown exceeds the threshold.
    """
    tracked = running_max(windows, "symbol", "window_start", "vwap", out="vwap_high")
    return mark_drawdown(tracked, threshold)


def mark_drawdown(tracked: DataFrame, threshold: float = DRAWDOWN_RATIO) -> DataFrame:
    """Alert columns of windows that carry their running ``vwap_high``."""
    high = F.greatest(F.col("vwap_high"), F.lit(0.0))
    breached = drawdown_ratio(high, F.col("vwap")) > threshold
    kept = [c for c in tracked.columns if c != "vwap_high"]
    return tracked.select(
        *kept,
        F.when(breached, "DRAWDOWN").alias("alert_type"),
        F.when(breached, high).alias("session_high"),
        F.when(breached, drawdown_pct(high, F.col("vwap"), 2)).alias("drawdown_pct"),
    )

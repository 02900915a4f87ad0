"""Ad-hoc questions asked of the window lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.risk import DRAWDOWN_RATIO, drawdown_pct, drawdown_ratio
from tickloom.operators.ordered import latest_per_key

_NEWEST = ["window_end", "trade_count", "vwap"]


def session_summary(windows: DataFrame) -> DataFrame:
    """Session VWAP, range, volatility and totals per symbol."""
    low, high = F.min("min_price"), F.max("max_price")
    return windows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg("vwap"), 2).alias("avg_vwap"),
        F.round(low, 2).alias("session_low"),
        F.round(high, 2).alias("session_high"),
        F.round(F.avg("volatility"), 6).alias("avg_volatility"),
        F.round(high / F.nullif(low, F.lit(0.0)) - 1, 4).alias("session_range_pct"),
        F.sum("trade_count").cast("bigint").alias("total_trades"),
        F.round(F.sum("total_volume"), 0).alias("total_volume"),
    )


def scan_summary(windows: DataFrame) -> DataFrame:
    """The five-column summary used to compare lake formats."""
    return windows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg("vwap"), 2).alias("avg_vwap"),
        F.round(F.avg("volatility"), 6).alias("avg_volatility"),
        F.sum("trade_count").cast("bigint").alias("total_trades"),
    )


def latest_window(windows: DataFrame) -> DataFrame:
    """The most recent window of each symbol."""
    return latest_per_key(
        windows.select("symbol", "window_end", "vwap", "volatility", "trade_count", "total_volume"),
        ["symbol"],
        _NEWEST,
    ).select(
        "symbol",
        "window_end",
        F.round("vwap", 2).alias("vwap"),
        F.round("volatility", 6).alias("volatility"),
        "trade_count",
        F.round("total_volume", 0).alias("total_volume"),
    )


def latest_facts(facts: DataFrame) -> DataFrame:
    """The most recent fact of each symbol, as the serving layer reads it."""
    served = facts.select(
        "symbol",
        "window_start",
        "window_end",
        "vwap",
        "volatility",
        "drawdown_pct",
        "session_high",
    )
    return latest_per_key(served, ["symbol"], ["window_end", "window_start"])


def latest_scan(windows: DataFrame) -> DataFrame:
    """The three-column form of the latest window used to compare lake formats."""
    narrow = windows.select("symbol", "window_end", "vwap", "volatility")
    return latest_per_key(narrow, ["symbol"], ["window_end"]).drop("window_end")


def drawdown_vs_session(windows: DataFrame, threshold: float | None = DRAWDOWN_RATIO) -> DataFrame:
    """Latest VWAP of each symbol against the high of the whole session.

    Both sides come out of one aggregation, so the windows are read and shuffled once.
    ``threshold=None`` keeps every symbol.
    """
    pairs = windows.groupBy("symbol").agg(
        F.max("max_price").alias("_high"),
        F.max(F.struct(*_NEWEST)).alias("_last"),
    )
    high, vwap = F.col("_high"), F.col("_last.vwap")
    if threshold is not None:
        pairs = pairs.filter(drawdown_ratio(high, vwap) > threshold)
    return pairs.select(
        "symbol",
        F.round(vwap, 2).alias("current_vwap"),
        F.round(high, 2).alias("session_high"),
        drawdown_pct(high, vwap, 2).alias("drawdown_pct"),
        F.col("_last.window_end").alias("window_end"),
    )


def volatility_trend(windows: DataFrame) -> DataFrame:
    """Every window's volatility; a listing orders it by symbol and time where it is shown."""
    return windows.select(
        "symbol",
        "window_start",
        F.round("vwap", 2).alias("vwap"),
        F.round("volatility", 6).alias("volatility"),
        "trade_count",
    )


def windows_per_symbol(windows: DataFrame) -> DataFrame:
    return windows.groupBy("symbol").agg(F.count(F.lit(1)).alias("windows"))


def full_scan_count(windows: DataFrame) -> DataFrame:
    return windows.agg(F.count(F.lit(1)).alias("row_count"))


def symbol_filter(windows: DataFrame, symbol: str) -> DataFrame:
    return windows.filter(F.col("symbol") == symbol)

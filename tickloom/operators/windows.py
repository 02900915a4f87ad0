"""Tick windows: VWAP, volatility, range, volume, and open/close prices per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.risk import PRICE_DP, VOLATILITY_DP, VOLUME_DP, window_direction

DEFAULT_WIDTH = "5 minutes"


def window_metrics(price: str = "price", size: str = "size") -> list[Column]:
    """Metrics of one group of ticks; all of them merge from partial aggregates."""
    p, s = F.col(price), F.col(size)
    traded = F.sum(s)
    vwap = F.when(traded == 0, F.lit(0.0)).otherwise(F.sum(p * s) / traded)
    return [
        F.round(vwap, PRICE_DP).alias("vwap"),
        F.round(F.min(p), PRICE_DP).alias("min_price"),
        F.round(F.max(p), PRICE_DP).alias("max_price"),
        F.round(F.stddev_pop(p), VOLATILITY_DP).alias("volatility"),
        F.round(F.max(p) - F.min(p), PRICE_DP).alias("price_range"),
        F.count(F.lit(1)).alias("trade_count"),
        F.round(traded, VOLUME_DP).alias("total_volume"),
    ]


def aggregate_windows(
    ticks: DataFrame, width: str = DEFAULT_WIDTH, slide: str | None = None
) -> DataFrame:
    """Window metrics keyed by symbol and the ``window`` struct; batch or streaming."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return ticks.groupBy("symbol", window.alias("window")).agg(*window_metrics())


def vwap_windows(
    ticks: DataFrame, width: str = DEFAULT_WIDTH, slide: str | None = None
) -> DataFrame:
    """One row per symbol and event-time window, rounded at write precision."""
    grouped = aggregate_windows(ticks, width, slide)
    metrics = [c for c in grouped.columns if c not in ("symbol", "window")]
    return grouped.select(
        "symbol",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *metrics,
    )


def window_open_close(ticks: DataFrame, width: str = DEFAULT_WIDTH) -> DataFrame:
    """First and last price of each window and its direction.

    Ticks that share a timestamp have no arrival order, so the lower price counts as
    earlier; the result does not depend on how the input is split.
    """
    order = F.struct("ts", "price")
    return (
        ticks.groupBy("symbol", F.window("ts", width).alias("window"))
        .agg(
            F.min(order).getField("price").alias("open_price"),
            F.max(order).getField("price").alias("close_price"),
        )
        .select(
            "symbol",
            F.col("window.start").alias("window_start"),
            "open_price",
            "close_price",
            window_direction(F.col("open_price"), F.col("close_price")).alias("direction"),
        )
    )

"""Positions: trade enrichment and portfolio value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def position_pnl(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """Trades with notional, unrealised profit and profit percent of the position they touch.

    Amounts use the unrounded trade price. A trade without a position keeps its notional and
    has no profit. The join carries no hint: Spark broadcasts the positions when their size
    allows it, and otherwise sort-merges with skewed symbols split.
    """
    price, cost = F.col("price"), F.col("avg_cost")
    held = positions.select("symbol", "avg_cost", "total_shares")
    return trades.join(held, "symbol", "left").select(
        *[c for c in trades.columns if c != "price"],
        F.round(price, 2).alias("price"),
        F.round(F.col("shares") * price, 2).alias("notional"),
        "avg_cost",
        "total_shares",
        F.round((price - cost) * F.col("total_shares"), 2).alias("unrealized_pnl"),
        F.round((price / F.nullif(cost, F.lit(0.0)) - 1) * 100, 2).alias("pnl_pct"),
    )


def portfolio_value(ticks: DataFrame, positions: DataFrame) -> DataFrame:
    """Market value of all positions at the last price of each symbol.

    Symbols without a tick are valued at cost. The last price is a mergeable aggregate, so
    the join sees one row per symbol.
    """
    last = ticks.groupBy("symbol").agg(F.max(F.struct("ts", "price")).alias("_last"))
    valued = positions.join(last, "symbol", "left").select(
        F.col("total_shares"), F.coalesce(F.col("_last.price"), F.col("avg_cost")).alias("price")
    )
    return valued.agg(
        F.count(F.lit(1)).alias("positions"),
        F.round(F.sum(F.col("price") * F.col("total_shares")), 2).alias("market_value"),
    )

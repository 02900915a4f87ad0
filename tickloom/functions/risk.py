"""Risk expressions shared by the batch and streaming operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, labels and write-time precisions of the risk metrics.
DRAWDOWN_RATIO = 0.03
DRAWDOWN_PCT = 3.0
WATCH_RANK = 3
REGIME_CUTS = (("HIGH", 0.05), ("MEDIUM", 0.015))
REGIME_FLOOR = "LOW"
PRICE_DP, VOLATILITY_DP, VOLUME_DP = 4, 6, 2


def drawdown_ratio(high: Column, price: Column) -> Column:
    """Share of ``high`` that ``price`` lies below it; null where the high is 0 or unknown."""
    return (high - price) / F.nullif(high, F.lit(0.0))


def drawdown_pct(high: Column, price: Column, dp: int) -> Column:
    return F.round(drawdown_ratio(high, price) * 100, dp)


def volatility_regime(avg_volatility: Column) -> Column:
    """Regime label of an average volatility; cuts are strict and null counts as the floor."""
    label = F.lit(REGIME_FLOOR)
    for name, cut in reversed(REGIME_CUTS):
        label = F.when(avg_volatility > cut, name).otherwise(label)
    return label


def alert_type(drawdown: Column, rank: Column, threshold: float = DRAWDOWN_PCT) -> Column:
    return (
        F.when(drawdown > threshold, "DRAWDOWN").when(rank == 1, "HIGHEST_VOL").otherwise("WATCH")
    )


def window_direction(open_price: Column, close_price: Column) -> Column:
    return F.when(close_price >= open_price, "UP").otherwise("DOWN")


def _utc_clock(ts: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session's time zone is."""
    seconds = F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of an instant in UTC, with microseconds only where there are any."""
    clock = F.regexp_replace(F.substring(_utc_clock(ts).cast("string"), 1, 19), " ", "T")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    return F.concat(clock, F.when(micros != 0, fraction).otherwise(""), F.lit("+00:00"))


def utc_date(ts: Column) -> Column:
    """The UTC date of an instant, whatever the session's time zone is."""
    return F.to_date(_utc_clock(ts))

"""Number and time formats of the rendered documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, dp: int) -> Column:
    """``dp`` decimals, rounded half up on the decimal value; null stays null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{dp}f", F.round(value, dp)))


def shortest(value: Column, dp: int = 2) -> Column:
    """A number already rounded to ``dp`` places without padding zeros, at least one decimal."""
    return F.regexp_replace(fixed(value, dp), r"(\.\d+?)0+$", "$1")


def thousands(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%,d", value.cast("bigint")))


def wall_clock(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, followed by microseconds only where there are any."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
    )

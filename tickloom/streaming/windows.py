"""Streaming windows: event-time aggregation, closed by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.windows import DEFAULT_WIDTH, aggregate_windows

DEFAULT_DELAY = "10 minutes"


def stream_windows(
    ticks: DataFrame,
    width: str = DEFAULT_WIDTH,
    delay: str = DEFAULT_DELAY,
    slide: str | None = None,
) -> DataFrame:
    """Window rows of a tick stream, each emitted once, when the watermark passes its end.

    ``closed_at`` carries the event time on to a following stateful step. Ticks later than
    ``delay`` are dropped and counted in the query progress.
    """
    timed = ticks.withWatermark("ts", delay)
    grouped = aggregate_windows(timed, width, slide)
    metrics = [c for c in grouped.columns if c not in ("symbol", "window")]
    return grouped.select(
        "symbol",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *metrics,
        F.window_time("window").alias("closed_at"),
    )

"""Windows of a stream that also close when their symbol falls silent."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.risk import PRICE_DP, VOLATILITY_DP, VOLUME_DP
from tickloom.schemas import WINDOW
from tickloom.session import scratch_path
from tickloom.streaming.sinks import file_writer

_NUMBERS = ("n", "mean", "spread", "low", "high", "traded", "paid")
_OPEN = T.StructType([T.StructField(c, T.LongType() if c == "n" else T.DoubleType()) for c in _NUMBERS])
_START = T.StructType([T.StructField("start", T.LongType())])
_TIME = T.StructType([T.StructField("at", T.LongType())])
_CLOSED = T.StructType([T.StructField("symbol", T.StringType()), *_START.fields, *_OPEN.fields])


def _merged(a: tuple, b: tuple) -> tuple:
    """Two parts of a window: count, mean, squared distances from it, extremes, volume and amount."""
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return (
        n, a[1] + apart * b[0] / n, a[2] + b[2] + apart * apart * a[0] * b[0] / n,
        min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5], a[6] + b[6],
    )


class SilentWindows(StatefulProcessor):
    """The open windows of a symbol, a few numbers each, and one timer.

    A window closes when the symbol's own event time passes its end by the delay, or when no
    tick of the symbol has come for the idle time: the timer, set anew with every batch that
    has ticks of the symbol, then closes what is open. Ticks of closed windows are too late.
    """

    def __init__(self, width: int, delay: int, idle: int):
        self._width, self._delay, self._idle = width, delay, idle  # microseconds, idle: milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getMapState("open", _START, _OPEN)
        self._latest = handle.getValueState("latest", _TIME)
        self._closed = handle.getValueState("closed", _TIME)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = self._closed.get()[0] if self._closed.exists() else None
        latest = self._latest.get()[0] if self._latest.exists() else None
        for chunk in rows:
            starts = chunk["at"].to_numpy(np.int64) // self._width * self._width
            newest = int(chunk["at"].max())
            latest = newest if latest is None else max(latest, newest)
            for start, ticks in chunk.groupby(starts):
                if closed is not None and start + self._width <= closed:
                    continue
                price, size = ticks["price"].to_numpy(float), ticks["size"].to_numpy(float)
                part = (
                    len(price), float(price.mean()), float(((price - price.mean()) ** 2).sum()),
                    float(price.min()), float(price.max()), float(size.sum()), float((price * size).sum()),
                )
                place = (int(start),)
                if self._open.containsKey(place):
                    part = _merged(tuple(self._open.getValue(place)), part)
                self._open.updateValue(place, part)
        if latest is None:
            return
        self._latest.update((latest,))
        yield from self._close(key, latest - self._delay, closed)
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if any(True for _ in self._open.keys()):
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ends = [start + self._width for (start,) in self._open.keys()]
        if ends:
            yield from self._close(key, max(ends), self._closed.get()[0] if self._closed.exists() else None)

    def _close(self, key, until: int, closed: int | None) -> Iterator[pd.DataFrame]:
        """Give and forget the windows that end by ``until``."""
        done = [(start, tuple(numbers)) for (start,), numbers in self._open.iterator() if start + self._width <= until]
        for start, _ in done:
            self._open.removeKey((start,))
        self._closed.update((until if closed is None else max(until, closed),))
        if done:
            rows = [(key[0], start, *numbers) for start, numbers in sorted(done)]
            yield pd.DataFrame(rows, columns=_CLOSED.fieldNames())

    def close(self) -> None:
        pass


def _micros(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1_000_000)


def stream_silent_windows(
    ticks: DataFrame, width: str = "5 minutes", delay: str = "10 minutes", idle: str = "10 minutes"
) -> DataFrame:
    """Window rows of a tick stream, each once; those of silent symbols after ``idle`` of processing time.

    ``stream_windows`` closes by the watermark of all symbols, so the last windows wait for later
    ticks of any symbol. Here each symbol has its own event time, and a timer. Ticks without a
    symbol, time, price or size are left out. It needs a trigger that goes on without data.
    """
    micros = F.unix_micros("ts").alias("at")
    usable = ticks.select("symbol", micros, F.col("price").cast("double"), F.col("size").cast("double")).dropna()
    closed = usable.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=SilentWindows(_micros(width), _micros(delay), _micros(idle) // 1000),
        outputStructType=_CLOSED, outputMode="Append", timeMode="ProcessingTime",
    )
    start = F.timestamp_micros("start")
    vwap = F.when(F.col("traded") == 0, F.lit(0.0)).otherwise(F.col("paid") / F.col("traded"))
    return closed.select(
        "symbol", start.alias("window_start"), F.timestamp_micros(F.col("start") + _micros(width)).alias("window_end"),
        F.round(vwap, PRICE_DP).alias("vwap"), F.round("low", PRICE_DP).alias("min_price"),
        F.round("high", PRICE_DP).alias("max_price"),
        F.round(F.sqrt(F.col("spread") / F.col("n")), VOLATILITY_DP).alias("volatility"),
        F.round(F.col("high") - F.col("low"), PRICE_DP).alias("price_range"),
        F.col("n").alias("trade_count"), F.round("traded", VOLUME_DP).alias("total_volume"),
    ).select(*WINDOW.fieldNames())


def replay_until_silent(stream: DataFrame, name: str, idle: str, timeout: float = 600) -> DataFrame:
    """Work off what has arrived, wait until the timers have run, and stop: into a stored table.

    The query goes on in short batches; it is stopped once no row has come in for twice the
    idle time and a batch has begun after that.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    query = file_writer(stream, path, checkpoint).trigger(processingTime="500 milliseconds").start()
    wait, began = 2 * _micros(idle) / 1e6, time.monotonic()
    quiet, seen = None, -1
    try:
        while True:
            if query.exception():
                raise query.exception()
            if time.monotonic() - began > timeout:
                raise TimeoutError(f"stream {name} did not fall silent within {timeout} s")
            progress = query.lastProgress
            if progress and progress["batchId"] != seen:
                seen = progress["batchId"]
                if progress["numInputRows"] or quiet is None:
                    quiet = time.monotonic()
                elif time.monotonic() - quiet > wait:
                    break
            time.sleep(0.2)
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(path)

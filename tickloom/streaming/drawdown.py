"""Session highs over closed windows, kept as one number of state per symbol."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.risk import DRAWDOWN_RATIO
from tickloom.operators.models import mark_drawdown
from tickloom.schemas import WINDOW

_HIGH = T.StructType([T.StructField("high", T.DoubleType())])
_TRACKED = T.StructType([*WINDOW.fields, T.StructField("vwap_high", T.DoubleType())])


class SessionHigh(StatefulProcessor):
    """Adds the running maximum VWAP of the symbol to each closed window.

    A symbol's windows of one batch are put in time order before the state moves on. They are
    few: a batch on an interval holds what closed in it, and ``lake_stream`` bounds the files
    of a batch that catches up.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._high = handle.getValueState("high", _HIGH)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = pd.concat(rows, ignore_index=True).sort_values("window_start")
        known = self._high.get()[0] if self._high.exists() else float("-inf")
        closed["vwap_high"] = closed["vwap"].cummax().clip(lower=known)
        self._high.update((float(closed["vwap_high"].iloc[-1]),))
        yield closed[_TRACKED.fieldNames()]

    def close(self) -> None:
        pass


def stream_drawdown(windows: DataFrame, threshold: float = DRAWDOWN_RATIO) -> DataFrame:
    """Closed windows of a stream with alert columns, against the running VWAP high."""
    tracked = windows.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=SessionHigh(),
        outputStructType=_TRACKED,
        outputMode="Append",
        timeMode="None",
    )
    return mark_drawdown(tracked, threshold)

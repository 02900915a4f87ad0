"""Schemas of every relation, and the contracts of the published ones."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_STR, _DBL, _LONG, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


TICK = _struct(
    ("symbol", _STR),
    ("price", _DBL),
    ("size", _DBL),
    ("ts", _TS),
    ("source", _STR),
    ("exchange", _STR),
    ("conditions", T.ArrayType(_STR)),
)

# Price, size and timestamp are read as text, so that a number sent as a string is accepted
# and a bad one can be told apart from a missing one. Text that is no JSON object, or only the
# start of one, lands in the last column.
TICK_WIRE = _struct(
    ("symbol", _STR),
    ("price", _STR),
    ("size", _STR),
    ("timestamp", _STR),
    ("source", _STR),
    ("exchange", _STR),
    ("conditions", T.ArrayType(_STR)),
    ("_corrupt_record", _STR),
)

PORTFOLIO_EVENT = _struct(
    ("event_type", _STR),
    ("symbol", _STR),
    ("shares", _LONG),
    ("price", _DBL),
    ("notional", _DBL),
    ("portfolio_id", _STR),
    ("timestamp", _STR),
    (
        "metadata",
        _struct(
            ("avg_cost", _DBL),
            ("total_shares", _LONG),
            ("unrealized_pnl", _DBL),
            ("pnl_pct", _DBL),
        ),
    ),
)

POSITION = _struct(
    ("symbol", _STR), ("total_shares", _LONG), ("avg_cost", _DBL), ("volatility", _DBL)
)

_METRICS = (
    ("vwap", _DBL),
    ("min_price", _DBL),
    ("max_price", _DBL),
    ("volatility", _DBL),
    ("price_range", _DBL),
    ("trade_count", _LONG),
    ("total_volume", _DBL),
)

WINDOW = _struct(("symbol", _STR), ("window_start", _TS), ("window_end", _TS), *_METRICS)

# A lake written elsewhere may hold the window bounds as ISO-8601 text.
WINDOW_TEXT = _struct(("symbol", _STR), ("window_start", _STR), ("window_end", _STR), *_METRICS)

ALERT_MESSAGE = _struct(
    ("symbol", _STR),
    ("window_start", _STR),
    ("window_end", _STR),
    *_METRICS,
    ("alert_type", _STR),
    ("session_high", _DBL),
    ("drawdown_pct", _DBL),
)

DOCUMENT = _struct(("id", _STR), ("text", _STR), ("symbol", _STR), ("type", _STR))


@dataclass(frozen=True)
class Contract:
    """What a published relation promises: columns and types, required columns, key, tests."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    tested_not_null: tuple[str, ...] = field(default=())


# The published contracts (column order, types, not-null, key, data tests).
STAGING_CONTRACT = Contract(
    name="stg_windows",
    schema=WINDOW,
    tested_not_null=("symbol", "window_start", "vwap", "trade_count"),
)
FACT_CONTRACT = Contract(
    name="vwap_facts",
    schema=_struct(
        ("symbol", _STR),
        ("window_start", _TS),
        ("window_end", _TS),
        *_METRICS,
        ("session_high", _DBL),
        ("drawdown_pct", _DBL),
        ("volatility_rank", _LONG),
    ),
    required=("symbol", "window_start", "vwap", "session_high"),
    tested_not_null=("symbol", "vwap", "session_high"),
)
SUMMARY_CONTRACT = Contract(
    name="portfolio_summary",
    schema=_struct(
        ("symbol", _STR),
        ("total_windows", _LONG),
        ("avg_vwap", _DBL),
        ("session_low", _DBL),
        ("session_high", _DBL),
        ("session_range", _DBL),
        ("avg_volatility", _DBL),
        ("peak_volatility", _DBL),
        ("total_trades", _LONG),
        ("total_volume", _DBL),
        ("max_drawdown_pct", _DBL),
        ("session_start", _TS),
        ("last_updated", _TS),
        ("volatility_regime", _STR),
    ),
    required=("symbol", "volatility_regime"),
    key=("symbol",),
    tested_not_null=("symbol",),
)
ALERT_CONTRACT = Contract(
    name="volatility_alerts",
    schema=_struct(
        ("symbol", _STR),
        ("alert_time", _TS),
        ("current_vwap", _DBL),
        ("session_high", _DBL),
        ("drawdown_pct", _DBL),
        ("volatility", _DBL),
        ("volatility_rank", _LONG),
        ("alert_type", _STR),
    ),
    required=("symbol", "alert_type"),
    tested_not_null=("symbol",),
)

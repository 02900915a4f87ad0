"""Tick and portfolio-event messages: decode, normalise, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.risk import iso_utc
from tickloom.schemas import PORTFOLIO_EVENT, TICK_WIRE

# Defaults of the normalised tick.
UNKNOWN_EXCHANGE = "unknown"
# Columns that decoding makes; all others came with the message.
_TICK_COLUMNS = {
    "symbol", "price", "size", "ts", "source", "exchange", "conditions", "reject_reason", "rejected_value",
}


def _number(text: Column) -> Column:
    """A finite double, or null. Text such as 'NaN' parses as a number but is no price."""
    number = text.try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number)


def _parsed(raw: DataFrame, value: str, schema: T.StructType, keep_text: bool) -> DataFrame:
    """``raw`` with the JSON fields of ``value`` as columns, all null where it is no JSON object.

    Unnesting through a generator parses each message once. A plain projection would let the
    optimizer copy the parser into every filter on its fields.
    """
    text = F.col(value).cast("string")
    others = [c for c in raw.columns if c != value]
    kept = [text.alias("_text")] if keep_text else []
    return raw.select(*others, *kept, F.inline(F.array(F.from_json(text, schema))))


def decode_ticks(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON tick messages; every message comes out, bad ones with ``reject_reason``.

    Works on batch and streaming input. ``split_ticks`` separates the two kinds.
    """
    others = [c for c in raw.columns if c != value]
    price, size = _number(F.col("price")), _number(F.col("size"))
    ts = F.col("timestamp").try_cast("timestamp")
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), "not json")
        .when(F.col("symbol").isNull(), "no symbol")
        .when(F.col("price").isNull(), "no price")
        .when(F.col("size").isNull(), "no size")
        .when(price.isNull(), "bad price")
        .when(size.isNull(), "bad size")
        .when(ts.isNull(), "bad timestamp")
    )
    return _parsed(raw, value, TICK_WIRE, keep_text=True).select(
        *others,
        "symbol",
        price.alias("price"),
        size.alias("size"),
        ts.alias("ts"),
        "source",
        F.coalesce("exchange", F.lit(UNKNOWN_EXCHANGE)).alias("exchange"),
        F.coalesce("conditions", F.array().cast("array<string>")).alias("conditions"),
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.col("_text")).alias("rejected_value"),
    )


def split_ticks(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable ticks, and the quarantined messages with the reason.

    What came beside a message's value (its key, an event id) stays with a rejected one, so
    that it can be traced and sent again.
    """
    good = decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason", "rejected_value")
    context = [c for c in decoded.columns if c not in _TICK_COLUMNS]
    bad = decoded.filter(F.col("reject_reason").isNotNull()).select(
        *context, F.col("rejected_value").alias("value"), "reject_reason"
    )
    return good, bad


def decode_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Portfolio-event messages as flat columns, nested ``metadata`` included."""
    others = [c for c in raw.columns if c != value]
    flat = [f.name for f in PORTFOLIO_EVENT if f.name not in ("timestamp", "metadata")]
    return _parsed(raw, value, PORTFOLIO_EVENT, keep_text=False).select(
        *others, *flat, F.col("timestamp").try_cast("timestamp").alias("ts"), "metadata.*"
    )


def normalize_ticks(trades: DataFrame, source: str) -> DataFrame:
    """Feed trades in the common tick shape: UTC time, float numbers, defaults filled in.

    Text that is no finite number or no time becomes null and never ends the job;
    ``rejected_trades`` tells which trades that befalls.
    """
    exchange = F.col("exchange") if "exchange" in trades.columns else F.lit(None)
    conditions = F.col("conditions") if "conditions" in trades.columns else F.lit(None)
    return trades.select(
        "symbol",
        _number(F.col("price")).alias("price"),
        _number(F.col("size")).alias("size"),
        F.col("timestamp").try_cast("timestamp").alias("ts"),
        F.lit(source).alias("source"),
        F.coalesce(exchange.cast("string"), F.lit(UNKNOWN_EXCHANGE)).alias("exchange"),
        F.coalesce(conditions.cast("array<string>"), F.array().cast("array<string>")).alias(
            "conditions"
        ),
    )


def rejected_trades(trades: DataFrame) -> DataFrame:
    """The trades that ``normalize_ticks`` cannot read, as they came, with ``reject_reason``."""
    reason = (
        F.when(F.col("symbol").isNull(), "no symbol")
        .when(_number(F.col("price")).isNull(), "bad price")
        .when(_number(F.col("size")).isNull(), "bad size")
        .when(F.col("timestamp").try_cast("timestamp").isNull(), "bad timestamp")
    )
    return trades.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def keyed_json(df: DataFrame, key: str, *columns: Column | str) -> DataFrame:
    """(key, value) messages; columns that are null stay out of the JSON text."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value")
    )


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks as JSON messages keyed by symbol."""
    return keyed_json(
        ticks,
        "symbol",
        "symbol",
        "price",
        "size",
        iso_utc(F.col("ts")).alias("timestamp"),
        "source",
        "exchange",
        "conditions",
    )


def encode_events(events: DataFrame) -> DataFrame:
    """Enriched portfolio events as JSON messages keyed by symbol."""
    metadata = F.struct("avg_cost", "total_shares", "unrealized_pnl", "pnl_pct")
    return keyed_json(
        events,
        "symbol",
        "event_type",
        "symbol",
        "shares",
        "price",
        "notional",
        "portfolio_id",
        iso_utc(F.col("ts")).alias("timestamp"),
        metadata.alias("metadata"),
    )


def alert_messages(marked: DataFrame) -> DataFrame:
    """Every closed window as an alert message keyed by symbol.

    Only windows in drawdown carry ``alert_type``, ``session_high`` and ``drawdown_pct``.
    """
    plain = [c for c in marked.columns if c not in ("window_start", "window_end", "symbol")]
    return keyed_json(
        marked,
        "symbol",
        "symbol",
        iso_utc(F.col("window_start")).alias("window_start"),
        iso_utc(F.col("window_end")).alias("window_end"),
        *plain,
    )

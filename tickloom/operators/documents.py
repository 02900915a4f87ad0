"""Mart rows as text documents, and risk tokens found in text."""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import fixed, shortest, thousands, wall_clock
from tickloom.operators.session_queries import latest_facts
from tickloom.schemas import DOCUMENT

# Document texts; a field in braces is replaced by its formatted value.
SUMMARY_TEXT = """\
Symbol: {symbol}
Volatility Regime: {volatility_regime}
Average VWAP: ${avg_vwap}
Session Low: ${session_low} | Session High: ${session_high}
Session Range: ${session_range}
Average Volatility: {avg_volatility}
Peak Volatility: {peak_volatility}
Max Drawdown: {max_drawdown_pct}%
Total Trades: {total_trades}
Total Volume: ${total_volume}
Session Start: {session_start}
Last Updated: {last_updated}"""
ALERT_TEXT = """\
ALERT — Symbol: {symbol}
Alert Type: {alert_type}
Current VWAP: ${current_vwap}
Session High: ${session_high}
Drawdown: {drawdown_pct}%
Volatility: {volatility}
Volatility Rank: #{volatility_rank} across portfolio
Alert Time: {alert_time}"""
LATEST_TEXT = """\
Latest 5-min Window — Symbol: {symbol}
VWAP: ${vwap}
Volatility: {volatility}
Drawdown from session high: {drawdown_pct}%
Session High: ${session_high}
Window: {window_start} → {window_end}"""
# Token pattern and the colour class of each risk word. A word ends at anything
# but an ASCII letter, digit or underscore; the looks around it say so for any Java version.
TOKEN_PATTERN = (
    r"(\$[\d,.]+|\d+\.\d+%?|#\d+|(?<!\w)(?:HIGH|MEDIUM|LOW|HIGHEST_VOL|WATCH|DRAWDOWN)(?!\w))"
)
# What a token can begin with; checked first, it spares most positions of a text the choice.
TOKEN_START = r"(?=[$#\dHMLWD])"
TOKEN_WORDS = {
    "red": ("HIGH", "HIGHEST_VOL", "DRAWDOWN"),
    "amber": ("WATCH", "MEDIUM"),
    "green": ("LOW",),
}


def _filled(text: str, fields: dict[str, Column]) -> Column:
    """``text`` with its fields replaced; an unknown number reads ``nan``."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(text):
        parts.append(F.lit(literal))
        if name:
            parts.append(F.coalesce(fields[name].cast("string"), F.lit("nan")))
    return F.concat(*parts)


def _documents(df: DataFrame, kind: str, prefix: str, text: Column) -> DataFrame:
    return df.select(
        F.concat(F.lit(prefix), F.col("symbol")).alias("id"),
        text.alias("text"),
        F.col("symbol"),
        F.lit(kind).alias("type"),
    )


def summary_documents(summary: DataFrame) -> DataFrame:
    c = {name: F.col(name) for name in summary.columns}
    for name in ("avg_vwap", "session_low", "session_high", "session_range", "max_drawdown_pct"):
        c[name] = shortest(c[name])
    for name in ("avg_volatility", "peak_volatility"):
        c[name] = fixed(c[name], 6)
    c["total_volume"] = thousands(c["total_volume"])
    for name in ("session_start", "last_updated"):
        c[name] = wall_clock(c[name])
    return _documents(summary, "portfolio_summary", "summary_", _filled(SUMMARY_TEXT, c))


def alert_documents(alerts: DataFrame) -> DataFrame:
    c = {name: F.col(name) for name in alerts.columns}
    c["current_vwap"] = fixed(c["current_vwap"], 2)
    c["session_high"] = fixed(c["session_high"], 2)
    c["drawdown_pct"] = shortest(c["drawdown_pct"])
    c["volatility"] = fixed(c["volatility"], 6)
    c["alert_time"] = wall_clock(c["alert_time"])
    return _documents(alerts, "volatility_alert", "alert_", _filled(ALERT_TEXT, c))


def latest_documents(facts: DataFrame) -> DataFrame:
    latest = latest_facts(facts)
    c = {name: F.col(name) for name in latest.columns}
    c["vwap"] = fixed(c["vwap"], 4)
    c["volatility"] = fixed(c["volatility"], 6)
    c["drawdown_pct"] = fixed(c["drawdown_pct"], 4)
    c["session_high"] = fixed(c["session_high"], 2)
    c["window_start"] = wall_clock(c["window_start"])
    c["window_end"] = wall_clock(c["window_end"])
    return _documents(latest, "latest_window", "latest_", _filled(LATEST_TEXT, c))


def render_docs(summary: DataFrame, alerts: DataFrame, facts: DataFrame) -> DataFrame:
    """All documents: one per summary row, one per alert, one per symbol's latest window."""
    kinds = (summary_documents(summary), alert_documents(alerts), latest_documents(facts))
    return reduce(DataFrame.unionByName, kinds).select(*DOCUMENT.fieldNames())


def tag_risk_tokens(texts: DataFrame, id_column: str, text_column: str = "text") -> DataFrame:
    """Money, number, rank and risk-word tokens of each text, in order of appearance."""
    tokens = texts.select(
        id_column,
        F.posexplode(
            F.regexp_extract_all(text_column, F.lit(TOKEN_START + TOKEN_PATTERN), F.lit(1))
        ).alias("position", "token"),
    )
    token = F.col("token")
    kind = F.when(token.startswith("$"), "money").when(token.startswith("#"), "rank")
    for name, words in TOKEN_WORDS.items():
        kind = kind.when(token.isin(*words), name)
    return tokens.withColumn("kind", kind.otherwise("number"))

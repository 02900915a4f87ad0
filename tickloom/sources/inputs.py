"""Ticks, trades, positions and messages derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks_of_events(events: DataFrame) -> DataFrame:
    """Ticks out of ``events``, batch or streaming: type as symbol, value as price, k as size."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("events").alias("source"),
    )


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks_of_events(table(spark, folder, "events"))


def _file_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return files.parquet(folder)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as a file stream."""
    return _file_stream(spark, folder, "events")


def event_tick_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same ticks as a file stream."""
    return ticks_of_events(event_stream(spark, folder))


def lineitem_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks out of ``lineitem``: supplier as symbol, line price, quantity, ship date."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.lit("lineitem").alias("source"),
    )


def part_positions(spark: SparkSession, folder: str) -> DataFrame:
    """One position per part: size as shares held, retail price as average cost."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("symbol"),
        F.col("p_size").cast("bigint").alias("total_shares"),
        F.col("p_retailprice").alias("avg_cost"),
    )


def trades_of_lines(lines: DataFrame) -> DataFrame:
    """One trade event per line item, by part; batch or streaming."""
    return lines.select(
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("event_type"),
        F.col("l_partkey").alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("shares"),
        (F.col("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("price"),
        F.col("l_suppkey").cast("string").alias("portfolio_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )


def lineitem_trades(spark: SparkSession, folder: str) -> DataFrame:
    return trades_of_lines(table(spark, folder, "lineitem"))


def lineitem_trade_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same trades as a file stream."""
    return trades_of_lines(_file_stream(spark, folder, "lineitem"))


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_of_events(table(spark, folder, "events"))


def messages_of_events(events: DataFrame) -> DataFrame:
    """Every event as a tick message; the tens of its size decide how it is damaged.

    0 price as text (still a tick), 1 no size, 2 text price, 3 no JSON at all, 4 null price,
    5 not-a-number price, 6 no timestamp; larger sizes are sound.
    """
    kind = F.floor(F.get_json_object("props", "$.k").cast("double") / 10)
    price = F.col("value").cast("string")
    text = F.format_string(
        '{"symbol":"%s","price":%s%s%s,"source":"events"}',
        F.col("event_type"),
        F.when(kind == 0, F.concat(F.lit('"'), price, F.lit('"')))
        .when(kind == 2, '"abc"')
        .when(kind == 4, "null")
        .when(kind == 5, '"NaN"')
        .otherwise(price),
        F.when(kind == 1, "").otherwise(
            F.concat(F.lit(',"size":'), F.get_json_object("props", "$.k"))
        ),
        F.when(kind == 6, "").otherwise(
            F.concat(
                F.lit(',"timestamp":"'),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                F.lit('+00:00"'),
            )
        ),
    )
    return events.select("event_id", F.when(kind == 3, "not json").otherwise(text).alias("value"))

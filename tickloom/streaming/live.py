"""Live portfolio figures: streams joined with positions that change, and tables that keep up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.positions import position_pnl, portfolio_value
from tickloom.sources import versioned

BATCH = "batch_id"
_LAST_PRICE = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("ts", T.TimestampType())]
)


def publish_once(
    stream: DataFrame, path: str, checkpoint: str, derive: Callable[[DataFrame], DataFrame] | None = None
) -> DataStreamWriter:
    """Each batch, or what ``derive`` makes of it, into its own folder ``batch_id=N`` below ``path``.

    A batch that runs again after a failure replaces its folder, so a row that went out before
    the failure does not go out twice, and readers see the batch id with every row. ``derive``
    is called anew for every batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = derive(batch) if derive else batch
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What has been published, with the batch of each row."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(with_batch).parquet(path)


def live_pnl_writer(
    trades: DataFrame, positions: Callable[[], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """Trades of a stream with the profit of the position they touch, published once.

    ``positions`` reads the positions and is called for every batch: trades meet the positions as
    they stand when their batch starts, also if these were written anew since the last one.
    """
    return publish_once(trades, path, checkpoint, lambda batch: position_pnl(batch, positions()))


def last_prices(ticks: DataFrame) -> DataFrame:
    """``(symbol, price, ts)``: the last price of each symbol, batch or streaming (update mode).

    Of ticks at one time the highest price counts as the last.
    """
    last = ticks.groupBy("symbol").agg(F.max(F.struct("ts", "price")).alias("_last"))
    return last.select(F.col("symbol").cast("string").alias("symbol"), F.col("_last.price").alias("price"), F.col("_last.ts").alias("ts"))


def upsert(batch: DataFrame, target: str, key: str, order: str) -> None:
    """Put the rows of ``batch`` into the relation at ``target``; of a key the latest by ``order`` stays.

    The new version is complete before readers see it (``versioned.publish``). Writing the
    same batch again changes nothing. It costs the size of the relation, one row per key.
    """
    spark = batch.sparkSession
    try:
        rows = versioned.current(spark, target, batch.schema).unionByName(batch)
    except FileNotFoundError:
        rows = batch
    rest = [c for c in batch.columns if c not in (key, order)]
    newest = rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row"))
    versioned.publish(newest.select(key, "_row.*").select(*batch.columns), target)


def live_prices_writer(ticks: DataFrame, target: str, checkpoint: str) -> DataStreamWriter:
    """The last price of each symbol, kept up to date at ``target``.

    The stream keeps one price of state per symbol and passes on, each batch, the symbols whose
    price changed (update mode); these replace their rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        upsert(batch, target, "symbol", "ts")

    return (
        last_prices(ticks).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )


def live_portfolio_value(spark: SparkSession, target: str, positions: DataFrame) -> DataFrame:
    """The portfolio's value at the prices that ``live_prices_writer`` keeps."""
    prices = versioned.current(spark, target, _LAST_PRICE)
    return portfolio_value(prices, positions.withColumn("symbol", F.col("symbol").cast("string")))


def stored_highs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(symbol, vwap_high)`` out of the state of a ``stream_drawdown`` query, by Spark's state reader.

    It reads the last committed batch in the checkpoint, whether the query runs or has stopped.
    """
    state = spark.read.format("statestore").option("stateVarName", "high").load(checkpoint)
    return state.select(F.col("key.symbol").alias("symbol"), F.col("value.high").alias("vwap_high"))

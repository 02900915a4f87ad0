"""The tick archive: every message of the topic, read once, and what is built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions.risk import utc_date
from tickloom.operators.windows import DEFAULT_WIDTH, vwap_windows
from tickloom.sources.lake import BATCH_FILES, with_date
from tickloom.streaming.sinks import file_writer

# Messages that were rejected, or have no time, lie under this day.
NO_DAY = "1970-01-01"


def archive_writer(decoded: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Decoded messages into the archive, good and bad ones, exactly once per checkpoint.

    The archive is partitioned by ``rejected`` and UTC ``day``: usable ticks by their time, rejected
    messages, with reason, text and what came beside it, under ``NO_DAY``. As the topic is read
    by this stream alone, windows and quarantine cannot start at different offsets.
    """
    rejected = F.col("reject_reason").isNotNull()
    day = F.when(rejected, F.lit(NO_DAY).cast("date")).otherwise(utc_date(F.col("ts")))
    rows = decoded.withColumn("rejected", rejected).withColumn("day", day)
    return file_writer(rows, path, checkpoint).partitionBy("rejected", "day")


def _with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField("rejected", T.BooleanType()), T.StructField("day", T.DateType())]
    )


def archive_stream(
    spark: SparkSession, path: str, schema: T.StructType, batch_files: int = BATCH_FILES
) -> DataFrame:
    """Usable ticks as they arrive in the archive, a bounded number of files at a time."""
    files = spark.readStream.schema(_with_partitions(schema)).option("maxFilesPerTrigger", batch_files)
    return files.parquet(path).filter("NOT rejected").drop("rejected", "day", "reject_reason", "rejected_value")


def archived_ticks(spark: SparkSession, path: str, schema: T.StructType, first_day: str, last_day: str) -> DataFrame:
    """Usable ticks of a range of days, late ones included; other days are not read."""
    rows = spark.read.schema(_with_partitions(schema)).parquet(path)
    days = F.col("day").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return rows.filter(days & ~F.col("rejected")).drop("rejected", "day", "reject_reason", "rejected_value")


def archived_range(spark: SparkSession, path: str, schema: T.StructType) -> tuple[str, str]:
    """The first and the last day of usable ticks, by the folders' names; ``NO_DAY`` twice without any."""
    days = spark.read.schema(_with_partitions(schema)).parquet(path).filter("NOT rejected")
    row = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    return (str(row["first"]), str(row["last"])) if row["first"] else (NO_DAY, NO_DAY)


def quarantined(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected messages with their text and reason."""
    rows = spark.read.schema(_with_partitions(schema)).parquet(path).filter("rejected")
    context = [c for c in rows.columns if c not in (*_TICK, "rejected", "day", "rejected_value")]
    return rows.select(F.col("rejected_value").alias("value"), *context)


_TICK = ("symbol", "price", "size", "ts", "source", "exchange", "conditions")


def rebuild_days(
    spark: SparkSession,
    archive: str,
    schema: T.StructType,
    path: str,
    first_day: str,
    last_day: str,
    width: str = DEFAULT_WIDTH,
) -> None:
    """Write the windows that start on the days, from all archived ticks, over what ``path`` holds of them.

    This brings back the ticks that came too late for the stream. The rebuilt days are a lake
    root of their own; ``lake_scan(lake, rebuilt)`` reads both, and of a window's rows the one
    with more trades stands (``stg_windows``). The width divides a day.
    """
    windows = vwap_windows(archived_ticks(spark, archive, schema, first_day, last_day), width)
    (
        with_date(windows).hint("rebalance", "date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    )

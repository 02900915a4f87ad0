"""Stream sinks and bounded replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.session import scratch_path
from tickloom.sources.lake import with_date

# How often windows are flushed when the caller sets no trigger.
FLUSH_INTERVAL = "5 minutes"
# Files per date of one flush.
FLUSH_FILES = 2


def lake_writer(
    windows: DataFrame, path: str, checkpoint: str, files: int = FLUSH_FILES
) -> DataStreamWriter:
    """Closed windows into the date-partitioned lake, exactly once per checkpoint.

    Rows are gathered by date, at most ``files`` tasks a date, over as many tasks as the session
    shuffles with: a short flush writes few files, a catch-up run over many dates uses the
    whole cluster. ``compact_lake`` merges the files of many flushes.
    """
    rows = windows.drop("closed_at") if "closed_at" in windows.columns else windows
    gathered = with_date(rows).repartition("date", F.pmod(F.xxhash64("symbol"), F.lit(files)))
    return file_writer(gathered, path, checkpoint).partitionBy("date")


def file_writer(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def start(
    writer: DataStreamWriter, once: bool = False, every: str = FLUSH_INTERVAL
) -> StreamingQuery:
    """Run on an interval until stopped, or work off what has arrived and stop."""
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def replay(stream: DataFrame, name: str, timeout: int | None = None) -> DataFrame:
    """Work off everything a stream has, into a stored table in the shared folder.

    It takes as long as it takes, unless the caller sets a limit in seconds.
    """
    spark: SparkSession = stream.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    query = start(file_writer(stream, path, checkpoint), once=True)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {name} did not finish within {timeout} s")
    return spark.read.schema(stream.schema).parquet(path)

"""The window lake: date-partitioned Parquet, or a table in another format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.risk import utc_date
from tickloom.schemas import WINDOW

# Files that one batch of a stream over the lake reads at most.
BATCH_FILES = 1000


def lake_scan(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType = WINDOW,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """All lake files under the roots; a day range prunes ``date=`` partitions.

    The partition value is authoritative for ``date``, also where files repeat the column.
    """
    with_date = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    roots = [spark.read.schema(with_date).parquet(path) for path in paths]
    lake = reduce(DataFrame.unionByName, roots)
    if first_day:
        lake = lake.filter(F.col("date") >= F.lit(first_day).cast("date"))
    if last_day:
        lake = lake.filter(F.col("date") <= F.lit(last_day).cast("date"))
    return lake


def lake_stream(
    spark: SparkSession, path: str, schema: T.StructType = WINDOW, batch_files: int = BATCH_FILES
) -> DataFrame:
    """Windows as they arrive in a lake that a stream writes; each is read exactly once.

    A batch reads ``batch_files`` files at most, also when it starts over a lake of years, so
    what a stateful step gets of one symbol at once is bounded by the rows of so many files.
    """
    with_date = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    files = spark.readStream.schema(with_date).option("maxFilesPerTrigger", batch_files)
    return files.parquet(path).select(*schema.fieldNames())


def load_lake(spark: SparkSession, fmt: str, source: str) -> DataFrame:
    """The lake behind one name, whatever stores it: Parquet files or a catalog table."""
    if fmt == "parquet":
        return lake_scan(spark, source)
    if fmt == "table":
        return spark.table(source)
    return spark.read.format(fmt).load(source)


def with_date(windows: DataFrame) -> DataFrame:
    """Adds the partition column, the UTC date of the window start."""
    return windows.withColumn("date", utc_date(F.col("window_start")))


def write_lake(windows: DataFrame, path: str, mode: str = "append") -> None:
    """Append windows to the lake.

    Rows are rebalanced by date first, so a date costs a few well-sized files and a date
    that holds most of the rows is split over several tasks. A lake that a stream writes only
    shows what the stream committed, so batches belong in a root of their own; ``lake_scan``
    reads both.
    """
    (
        with_date(windows)
        .hint("rebalance", "date")
        .write.mode(mode)
        .partitionBy("date")
        .parquet(path)
    )


def compact_lake(lake: DataFrame, path: str) -> None:
    """All rows of ``lake`` into a lake of few, well-sized files per date at another ``path``.

    What is at ``path`` already is replaced, so a failed run can be repeated.
    """
    write_lake(lake.drop("date"), path, mode="overwrite")


def lake_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new rows together; columns are matched by name."""
    return existing.unionByName(new)

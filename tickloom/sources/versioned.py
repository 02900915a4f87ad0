"""Relations that are replaced as a whole while others read them.

A relation keeps two slots and a log. A refresh overwrites the slot that is not current, may
check what it wrote, and then appends one log row, which makes the slot current. Readers never
see half a refresh, a refresh may read the version it replaces, and storage stays at two
copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLOTS = ("a", "b")
_LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("slot", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("files", T.LongType()),
    ]
)


def history(spark: SparkSession, target: str) -> DataFrame:
    """The log, one row per refresh."""
    return spark.read.schema(_LOG).parquet(f"{target}/log")


def _newest(spark: SparkSession, target: str) -> tuple[int, str | None]:
    try:
        log = history(spark, target)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return 0, None
    row = log.agg(F.max(F.struct("version", "slot")).alias("newest")).first()["newest"]
    return (row["version"], row["slot"]) if row else (0, None)


def publish(
    df: DataFrame,
    target: str,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Replace the relation at ``target`` by ``df`` and return the stored version.

    ``check`` sees the written rows and raises to keep the old version current. The log counts
    the rows and files that were written.
    """
    spark = df.sparkSession
    version, slot = _newest(spark, target)
    free = _SLOTS[1] if slot == _SLOTS[0] else _SLOTS[0]
    df.write.mode("overwrite").parquet(f"{target}/{free}")
    stored = spark.read.schema(df.schema).parquet(f"{target}/{free}")
    if check:
        check(stored)
    by_file = stored.groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    size = by_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("files"))
    entry = size.select(
        F.lit(version + 1).cast("bigint").alias("version"),
        F.lit(free).alias("slot"),
        F.current_timestamp().alias("committed_at"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("files").cast("bigint").alias("files"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{target}/log")
    return stored


def current(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The current version of the relation at ``target``."""
    _, slot = _newest(spark, target)
    if slot is None:
        raise FileNotFoundError(f"nothing has been published at {target}")
    return spark.read.schema(schema).parquet(f"{target}/{slot}")

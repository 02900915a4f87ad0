"""The position dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import POSITION


def load_positions(spark: SparkSession, path: str) -> DataFrame:
    """Positions kept as Parquet in the same shape."""
    return spark.read.schema(POSITION).parquet(path)

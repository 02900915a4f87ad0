"""Stored lake and marts of one input folder, built on first use and then shared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.windows import DEFAULT_WIDTH, vwap_windows
from tickloom.plans.marts import Marts, build_marts
from tickloom.session import prepare, scratch_path
from tickloom.sources.inputs import event_ticks
from tickloom.sources.lake import lake_scan, write_lake

_BUILT: dict[tuple, object] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, times and sizes of the tables in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    tables = files.listStatus(path)
    return tuple(sorted((t.getPath().getName(), t.getModificationTime(), t.getLen()) for t in tables))


class Workspace:
    """What a deployment keeps on storage, for the ticks of one folder.

    Windows are written to a lake in the shared folder and marts are built from it, as in
    production, so queries on them read stored tables. Paths are remembered per application
    and state of the input: a table written anew is a new input.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        width: str = DEFAULT_WIDTH,
        ticks: Callable[[SparkSession, str], DataFrame] = event_ticks,
    ):
        self.spark = prepare(spark)
        self.folder = folder
        self.width = width
        self._ticks = ticks
        self._key = (
            spark.sparkContext.applicationId, folder, _state(spark, folder), width, ticks.__name__
        )

    def _once(self, name: str, build: Callable[[], object]):
        key = (*self._key, name)
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]

    def ticks(self) -> DataFrame:
        return self._ticks(self.spark, self.folder)

    def lake_path(self) -> str:
        def build() -> str:
            path = scratch_path(self.spark, "lake")
            write_lake(vwap_windows(self.ticks(), self.width), path)
            return path

        return self._once("lake", build)

    def lake(self) -> DataFrame:
        return lake_scan(self.spark, self.lake_path())

    def marts(self) -> Marts:
        return self._once(
            "marts", lambda: build_marts(self.lake(), scratch_path(self.spark, "marts"))
        )

"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Folders of applications, which go when their driver ends.
_OWNED: set[str] = set()


def build_session(app_name: str = "tickloom", **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` overrides any of them.

    On a cluster, pass ``spark.sql.shuffle.partitions`` of about shuffled bytes / 200 MB;
    adaptive execution merges what turns out too small and splits skewed joins.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings that results depend on (UTC wall clock, RocksDB state)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session (tests, laptops) may leave the setting out; it then gets a
    temporary folder. A cluster session without the setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tickloom-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses.

    It lies in a folder of the application, which owns it: all of it goes when the driver ends.
    """
    folder = f"{shared_root(spark)}/tickloom/{spark.sparkContext.applicationId}"
    if folder not in _OWNED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWNED.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several branches read one intermediate result: it is computed once,
    every branch sees the same values, and a lost executor only costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Helpers that several corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.session import scratch_path

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table, by Spark's own readers, so that the folder may lie in any store."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: later stages read files that all executors reach, so a lost
    executor costs a re-read and no recomputation. The files go when the application ends;
    ``drop_stored`` removes them earlier.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_path = path
    return stored


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table that ``store`` returned and nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def python_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Spark hands Python tasks about ``size`` bytes of rows at once in what is run inside.

    Both ends hold a batch several times over, as buffers, Arrow arrays and Python objects, for
    each task of an executor. The session's own size holds again afterwards.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


# A-Z to lower case; what is no ASCII letter, but ASCII, to a space. Bytes beyond ASCII stay.
_TERM_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def running_totals(numbers: Column, block: int = 256) -> Column:
    """The sums of the elements before each position of an array, in time n * block.

    Blocks are summed first, so that an array of a hundred thousand elements needs no
    quadratic number of additions.
    """

    def add(so_far: Column, x: Column) -> Column:
        return so_far + x

    zero = F.lit(0).cast("long")

    def total(array: Column, start: Column, count: Column) -> Column:
        return F.aggregate(F.slice(array, start, count), zero, add)

    def with_blocks(array: Column) -> Column:
        n_blocks = F.floor((F.size(array) + block - 1) / block).cast("int")
        sums = F.when(n_blocks > 0, F.transform(
            F.sequence(F.lit(0), n_blocks - 1),
            lambda b: total(array, b * block + 1, F.lit(block)),
        )).otherwise(F.array().cast("array<bigint>"))
        return let(sums, lambda s: with_offsets(array, s, n_blocks))

    def with_offsets(array: Column, sums: Column, n_blocks: Column) -> Column:
        offsets = F.when(n_blocks > 0, F.transform(
            F.sequence(F.lit(0), n_blocks - 1), lambda b: total(sums, F.lit(1), b)
        )).otherwise(F.array().cast("array<bigint>"))
        return let(offsets, lambda o: F.transform(
            array,
            lambda _, i: F.get(o, F.floor(i / block).cast("int"))
            + total(array, (F.floor(i / block) * block + 1).cast("int"), (i % block).cast("int")),
        ))

    return let(F.transform(numbers, lambda x: x.cast("long")), with_blocks)


def map_texts(
    docs: DataFrame,
    kind: str,
    work: Callable[[Iterator[list[bytes | None]]], Iterator[list[list]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Add columns that Python computes from whole texts, one Arrow batch at a time.

    ``work`` gets each batch's texts (UTF-8, None for null) and yields for each batch one list
    per column of ``kind`` (a DDL string). The columns ``keep`` of ``docs`` (all, if None) come
    along as the struct ``doc``, so that no name of theirs can clash with a new one.
    """
    fields = docs.columns if keep is None else keep
    new = T.StructType.fromDDL(kind)
    row = F.struct(*[docs[c] for c in fields]).alias("doc")
    rows = docs.select(row, F.col("text").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc"], *new.fields])
    arrow = [to_arrow_type(f.dataType) for f in new.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def texts() -> Iterator[list[bytes | None]]:
            for batch in batches:
                waiting.append(batch)
                yield batch.column("text").to_pylist()

        for columns in work(texts()):
            done = waiting.pop(0)
            made = [pa.array(c, t) for c, t in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([done.column("doc"), *made], names)

    return rows.mapInArrow(run, schema)

"""A mirror of the lake that is replaced as a whole and read at its current version."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import store
from tickloom.sources import versioned

# Buckets of a part whose digests are compared; rows are only shuffled where these differ.
BUCKETS = 256


def mirror_refresh(lake: DataFrame, target: str, fmt: str = "parquet") -> dict:
    """Replace the mirror by the rows of ``lake``; returns the rows and files that the mirror then holds.

    Parquet mirrors live at a path and are versioned there. Table formats bring their own
    snapshots and are written through the catalog, with ``target`` as the table name. The
    lake may be files or a table; an empty one is refused.
    """
    if lake.isEmpty():
        raise FileNotFoundError("the lake has no rows to mirror")
    if fmt == "parquet":
        versioned.publish(lake, target)
        log = versioned.history(lake.sparkSession, target)
        newest = log.agg(*[F.max_by(c, "version").alias(c) for c in ("row_count", "files")])
        return newest.first().asDict()
    lake.writeTo(target).using(fmt).createOrReplace()
    return {"row_count": lake.sparkSession.table(target).count(), "files": None}


def mirror_log(spark: SparkSession, target: str) -> DataFrame:
    return versioned.history(spark, target)


def mirror_scan(
    spark: SparkSession, target: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The current version of the mirror."""
    return versioned.current(spark, target, schema) if fmt == "parquet" else spark.table(target)


def _signed(lake: DataFrame, mirror: DataFrame, by: Column | None, buckets: int) -> DataFrame:
    """Rows of both sides as ``(row, part, bucket, net, hash)``; ``net`` is 1 in the lake and -1 in the mirror."""
    columns = lake.columns

    def side(df: DataFrame, net: int) -> DataFrame:
        # Hashes pass over nulls, so the nulls are told as well.
        row_hash = F.xxhash64(*[df[c] for c in columns], *[df[c].isNull() for c in columns])
        return df.select(
            F.struct(*[df[c] for c in columns]).alias("row"),
            (F.lit(0) if by is None else by).alias("part"),
            row_hash.alias("hash"),
        ).select(
            "row", "part", F.pmod("hash", F.lit(buckets)).alias("bucket"),
            F.lit(net).cast("long").alias("net"), "hash",
        )

    return side(lake, 1).unionByName(side(mirror, -1))


def _unequal(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys under which the two sides differ, by the number of rows or the sum of their hashes.

    The sum does not depend on the order, and a task sends one row per key. It is taken over
    three pieces of the hash, which no table is long enough to overflow.
    """
    pieces = [F.shiftrightunsigned("hash", 22 * i).bitwiseAND(F.lit((1 << 22) - 1)) for i in range(3)]
    sums = [F.sum(F.col("net") * piece).alias(f"piece{i}") for i, piece in enumerate(pieces)]
    digests = rows.groupBy(*keys).agg(F.sum("net").alias("rows"), *sums)
    return digests.where("rows <> 0 OR piece0 <> 0 OR piece1 <> 0 OR piece2 <> 0").select(*keys)


def _under(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The ``rows`` under the ``found`` keys; null is a key."""
    same = reduce(and_, [rows[k].eqNullSafe(found[k]) for k in found.columns])
    return rows.join(found, same, "left_semi")


def unequal_buckets(
    lake: DataFrame, mirror: DataFrame, by: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """``(part, bucket)`` of the rows that may differ: found from the top, first by part, then by bucket.

    A part is a value of ``by``, such as the date (the whole table, without it), a bucket one of
    ``buckets`` of a part by the rows' hashes. The second pass reads the differing parts alone.
    Both results are stored; they are as long as the differences are many.
    """
    rows = _signed(lake, mirror, by, buckets)
    parts = store(_unequal(rows, ["part"]), "unequal-parts")
    return store(_unequal(_under(rows, parts), ["part", "bucket"]), "unequal-buckets")


def mirror_parity(
    lake: DataFrame, mirror: DataFrame, by: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Rows that only one side has, counted with multiplicity.

    Digests of the sides are compared by part and bucket (see ``unequal_buckets``). Only rows of
    differing buckets are shuffled and reduced to (row, net count), copies merging before; if no
    bucket differs, none is. A row that differs in one column counts once on either side; columns
    are matched by name, nulls and NaN equal themselves, and empty sides are fine.
    """
    found = unequal_buckets(lake, mirror, by, buckets)
    if found.isEmpty():
        zero = F.lit(0).cast("long")
        return lake.sparkSession.range(1).select(zero.alias("only_in_lake"), zero.alias("only_in_mirror"))
    net = _under(_signed(lake, mirror, by, buckets), found).groupBy("row").agg(F.sum("net").alias("net"))
    return net.agg(
        F.coalesce(F.sum(F.greatest(F.col("net"), F.lit(0))), F.lit(0)).alias("only_in_lake"),
        F.coalesce(F.sum(F.greatest(-F.col("net"), F.lit(0))), F.lit(0)).alias("only_in_mirror"),
    )

"""Approximate nearest vectors: random-projection hash tables, joined by bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators.retrieval import BLOCK_BYTES, HITS, _finite, _one_batch, _unit_rows, topk_cosine
from tickloom.session import store

# Hash tables, and bits of a bucket's code. Each bit halves the vectors that a query meets in a table.
TABLES, BITS = 8, 6
SEED = 11
# Queries and documents whose scores a task holds at a time.
QUERY_SLICE, DOC_SLICE = 256, 8192
# Entries are compared with the planes as whole numbers of 1 / STEPS, so that no sum is rounded.
STEPS = 256


def hash_planes(width: int, tables: int = TABLES, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Random directions of entries -1 and 1, one per table and bit (rows, table by table)."""
    return np.random.default_rng(seed).integers(0, 2, (tables * bits, width)) * 2 - 1


def _coded(tables: int, bits: int, seed: int, id_type: T.DataType):
    """Adds each vector's bucket in every table: a bit per plane, set on its upper side."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits, dtype=np.int64)
    kind = to_arrow_schema(T.StructType([T.StructField("id", id_type), T.StructField("codes", T.ArrayType(T.LongType()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            entries, widths = vectors.flatten().to_numpy(zero_copy_only=False), vectors.value_lengths().to_numpy()
            codes = np.empty((len(vectors), tables), np.int64)
            for width in np.unique(widths).tolist():
                if width not in planes:
                    planes[width] = hash_planes(width, tables, bits, seed).astype(float)
                rows = widths == width
                x = np.floor(entries[np.repeat(rows, widths)].reshape(-1, width) * STEPS)
                sides = (x @ planes[width].T >= 0).reshape(-1, tables, bits)
                codes[rows] = (sides * weights).sum(axis=2)
            listed = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * tables, codes.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("id"), listed.cast(kind.field(1).type)], schema=kind)

    return run


def bucket_codes(vectors: DataFrame, key: str, tables: int = TABLES, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """``(id, width, table, code)``: a row per vector and hash table."""
    id_type = vectors.schema[key].dataType
    rows = vectors.select(F.col(key).alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kind = T.StructType([T.StructField("id", id_type), T.StructField("codes", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(_coded(tables, bits, seed, id_type), kind).select(
        "id", F.posexplode("codes").alias("table", "code")
    )


def _best_rows(queries: np.ndarray, docs: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(query, document, score)`` as row numbers: the ``k`` best of each query, ties to the earlier document.

    Once a query has ``k``, only scores above its worst one are looked at.
    """
    first = max(k, QUERY_SLICE)
    for start in range(0, len(queries), QUERY_SLICE):
        asked = queries[start : start + QUERY_SLICE]
        # Rounding first makes ties, and so the ranking, independent of the layout; -0.0 becomes 0.0.
        scores = np.round(asked @ docs[:first].T, 9) + 0.0
        found = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        scores = np.take_along_axis(scores, found, 1)
        number = np.arange(len(asked))
        for at in range(first, len(docs), DOC_SLICE):
            raw = asked @ docs[at : at + DOC_SLICE].T
            row, place = np.nonzero(raw > scores[:, -1:] + 4e-10)
            if not len(row):
                continue
            rows = np.concatenate([np.repeat(number, k), row])
            places = np.concatenate([found.ravel(), place + at])
            values = np.concatenate([scores.ravel(), np.round(raw[row, place], 9) + 0.0])
            order = np.lexsort((places, -values, rows))
            begins = np.searchsorted(rows[order], number)
            best = order[(begins[:, None] + np.arange(k)).ravel()]
            found, scores = places[best].reshape(-1, k), values[best].reshape(-1, k)
        yield np.repeat(number + start, found.shape[1]), found.ravel(), scores.ravel()


def _probes(asked: DataFrame, bits: int) -> DataFrame:
    """The buckets that a query looks into: its own, and those that differ in one bit."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: F.col("code").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    return asked.select(
        F.col("id").alias("query_id"), "table", F.explode(F.concat(F.array("code"), flips)).alias("code")
    )


def candidate_pairs(
    queries: DataFrame, docs: DataFrame, tables: int = TABLES, bits: int = BITS, seed: int = SEED
) -> DataFrame:
    """``(query_id, doc_id)``, once each: pairs that meet in a bucket of some table.

    A query looks into its own bucket and into those that differ in one bit. Only ids and
    codes are shuffled.
    """
    held = bucket_codes(docs, "doc_id", tables, bits, seed).withColumnRenamed("id", "doc_id")
    asked = bucket_codes(queries, "query_id", tables, bits, seed)
    probes = _probes(asked, bits)
    return probes.join(held, ["table", "code"]).select("query_id", "doc_id").distinct()


def _met_best(queries: DataFrame, docs: DataFrame, k: int, tables: int, bits: int, seed: int, block_bytes: int) -> DataFrame:
    """``(query_id, doc_id, score)``, once per pair of rows: of each bucket the ``k`` best for each row of ``queries``.

    Both tables are stored ones with a number ``_row``. A bucket meets in parts of about
    ``block_bytes`` of vectors of either kind, each in one task; only its best pairs leave it.
    """
    bucket, part = ["_w", "table", "code"], ["_d", "_q"]

    def in_buckets(rows: DataFrame, key: str, places: DataFrame) -> DataFrame:
        # Rows of one id are found by the buckets of any.
        return places.distinct().join(rows, key).select(key, "_row", "embedding", F.size("embedding").alias("_w"), "table", "code")

    held = in_buckets(docs, "doc_id", bucket_codes(docs, "doc_id", tables, bits, seed).withColumnRenamed("id", "doc_id"))
    asked = in_buckets(queries, "query_id", _probes(bucket_codes(queries, "query_id", tables, bits, seed), bits))

    def parts(rows: DataFrame, name: str) -> DataFrame:
        blocks = F.ceil(F.count(F.lit(1)) * F.col("_w") * 8 / F.lit(block_bytes)).cast("int")
        return rows.groupBy(bucket).agg(blocks.alias(name))

    sizes = store(parts(held, "_ds").join(parts(asked, "_qs"), bucket), "near-buckets")

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("_row"), F.col(of)).cast("int")

    def each(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    d = held.join(sizes, bucket).select("*", block("_ds").alias("_d"), each("_qs").alias("_q")).drop("_ds", "_qs")
    q = asked.join(sizes, bucket).select("*", block("_qs").alias("_q"), each("_ds").alias("_d")).drop("_ds", "_qs")
    pair = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("_asked", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("_held", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    out = to_arrow_schema(pair)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        asked, held = _one_batch(left), _one_batch(right)
        held = held.take(pc.sort_indices(held.column("doc_id")))
        best = [np.concatenate(c) for c in zip(*_best_rows(_unit_rows(asked.column("embedding")), _unit_rows(held.column("embedding")), k))]
        by, of = pa.array(best[0]), pa.array(best[1])
        columns = [asked.column("query_id").take(by), asked.column("_row").take(by)]
        columns += [held.column("doc_id").take(of), held.column("_row").take(of), pa.array(best[2])]
        return pa.Table.from_arrays(columns, schema=out)

    meet = bucket + part
    met = q.groupBy(meet).cogroup(d.groupBy(meet)).applyInArrow(score, pair)
    # A pair may meet in several tables.
    return met.groupBy("query_id", "_asked", "doc_id", "_held").agg(F.max("score").alias("score")).drop("_asked", "_held")


def approximate_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = HITS,
    tables: int = TABLES,
    bits: int = BITS,
    seed: int = SEED,
    complete: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: near documents by cosine, found without meeting all.

    ``queries`` has (query_id, embedding), ``docs`` (doc_id, embedding), each with unique ids. Every
    vector is hashed into ``tables`` buckets by the sides of ``bits`` random planes it is on: two
    vectors at an angle a agree in a bit with probability 1 - a / pi. A query is compared with the
    documents of its own buckets and of those one bit away, by their exact cosine; what is
    approximate is only that a near document may share no such bucket. More tables find more,
    more bits compare less; ``recall`` measures it. With ``complete``, queries that met fewer
    than ``k`` documents are searched exactly.

    Of equal vectors only the ``k`` smallest ids can be hits, so the others are left out before
    anything meets, and copies fill no bucket. Rows without a vector, or with a component that is
    no finite number, take no part; vectors are compared with those of their own length. Ties go
    to the smaller id. Vectors are shuffled once per bucket that they lie in or look into, a bucket
    meets in parts of ``block_bytes``, and of each part only a query's ``k`` best leave the task.
    """
    width = F.size("embedding")
    cast = F.col("embedding").cast("array<double>").alias("embedding")
    docs = docs.select("doc_id", cast).filter((width > 0) & _finite("embedding"))
    queries = queries.select("query_id", cast).filter((width > 0) & _finite("embedding"))
    copies = Window.partitionBy("embedding").orderBy("doc_id")
    docs = docs.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k).drop("_copy")
    number = F.monotonically_increasing_id().alias("_row")
    docs = store(docs.select("*", number), "near-docs")
    queries = store(queries.select("*", number), "near-queries")
    scored = _met_best(queries, docs, k, tables, bits, seed, block_bytes)
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    # Read three times below.
    found = store(scored.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k), "near-found")
    if not complete:
        return found
    full = found.filter(F.col("rank") == k).select("query_id")
    rest = queries.join(full, "query_id", "left_anti")
    if rest.isEmpty():
        return found
    exact = topk_cosine(rest, docs, k).select(*found.columns)
    return found.join(full, "query_id", "left_semi").unionByName(exact)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(hits, found, recall)``: how many of the exact hits were found."""
    both = exact.select("query_id", "doc_id").join(
        found.select("query_id", "doc_id", F.lit(1).alias("_found")), ["query_id", "doc_id"], "left"
    )
    hits = both.agg(F.count(F.lit(1)).alias("hits"), F.count("_found").alias("found"))
    return hits.withColumn("recall", F.col("found") / F.nullif("hits", F.lit(0)))

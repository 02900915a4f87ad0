"""Whitening of embeddings along their principal components, found incrementally."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm.common import store
from tickloom.llm.spectrum import Spectrum

# What binds op12: entries are whole numbers of 1 / SCALE; components that are given.
SCALE, COMPONENTS = 256, 4
# Spectra that one task merges.
FAN = 16
# A component below this share of the trace is rounding, and is not given.
LEAST_SHARE = 1e-10

_SPECTRUM = "part long, n long, sums array<long>, values array<double>, vectors array<double>"
_LONGEST = np.iinfo(np.int64).max


def scaled(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of each entry, as long; null if the vector or an entry is no number."""
    entries = F.col(vector).cast("array<double>")
    numbers = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.when(numbers, F.transform(entries, lambda c: F.floor(c * scale).cast("long")))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, width)


def _stored(part: int, s: Spectrum) -> dict:
    return {"part": part, "n": s.n, "sums": s.sums, "values": s.values, "vectors": s.vectors.ravel()}


def _read(row) -> Spectrum:
    s = Spectrum(len(row["sums"]))
    s.n, s.sums, s.values = int(row["n"]), np.array(row["sums"], np.int64), np.array(row["values"], float)
    s.vectors = np.array(row["vectors"], float).reshape(len(s.sums), -1)
    return s


def _spectra(width: int):
    """One spectrum for each partition that has a vector."""
    arrow = to_arrow_schema(T.StructType.fromDDL(_SPECTRUM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(width)
        for batch in batches:
            for x in _matrix(batch, width):
                own.add(x)
        if own.n:
            columns = {k: [v] for k, v in _stored(0, own).items()}
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    return run


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    first, *others = [_read(row) for _, row in rows.iterrows()]
    for other in others:
        first.merge(other)
    return pd.DataFrame([_stored(int(rows["part"].iat[0]) // FAN, first)])


def whole_spectrum(fit: DataFrame, width: int) -> Spectrum | None:
    """The spectrum of all vectors ``x`` of ``fit``; None without any.

    Partitions add their vectors one by one, ``FAN`` partial spectra become one in a task, round
    by round; the driver gets the last one: ``width**2`` numbers, however many vectors.
    """
    own = fit.select("x").mapInArrow(_spectra(width), _SPECTRUM).withColumn("part", F.spark_partition_id().cast("long"))
    spectra = store(own, "whitening-spectra")
    last = spectra.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while True:
        merged = spectra.groupBy(F.floor(F.col("part") / FAN).alias("_to")).applyInPandas(_merged, _SPECTRUM)
        if last < FAN:
            return _read(merged.first())
        spectra, last = store(merged, "whitening-spectra"), last // FAN


def _gram(fit: DataFrame, width: int, project: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sums of the products of projected vectors: a matrix per task, added up in one aggregation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = project(_matrix(batch, width))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["gram"])

    sums = fit.select("x").mapInArrow(run, "gram array<double>").select(F.posexplode("gram").alias("place", "value"))
    out = np.zeros(size * size)
    for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[row["place"]] = row["value"]
    return out.reshape(size, size)


def _deviations(away: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers, exactly; null where a long does not hold them."""
    if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * away.shape[1] < 2**62:
        return (away * away).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in away]
    return [s if s <= _LONGEST else None for s in sums]


class Whitening:
    """What is learned from the fit list: size, sums, components, and what they explain."""

    def __init__(self, n: int, sums: np.ndarray, axes: np.ndarray, values: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.axes, self.values, self.explained = n, sums, axes, values, explained

    def away(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly."""
        most = self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.sums).max(initial=0))
        if most < 2**62:
            return x * self.n - self.sums
        return x.astype(object) * self.n - self.sums.astype(object)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.away(x) / self.n).astype(float) @ self.axes / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The first components of the covariance of the vectors ``x`` of ``fit``; None without any.

    The spectrum that the partitions found gives a basis. In this basis the covariance is summed
    up once more over all vectors, centred first, and its eigenvectors turn the basis
    (Rayleigh-Ritz): what rounding the many updates have added is gone.
    """
    found = whole_spectrum(fit, width)
    if found is None:
        return None
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    plain = Whitening(found.n, found.sums, basis, np.ones(width), np.ones(width))
    values, turn = np.linalg.eigh(_gram(fit, width, plain.project, width) / found.n)
    trace = values.sum()
    kept = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > LEAST_SHARE * trace]
    axes = basis @ turn[:, kept]
    if kept:
        axes = axes / np.sqrt((axes * axes).sum(axis=0))
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(kept))] < 0, -1.0, 1.0)
    return Whitening(found.n, found.sums, axes, values[kept], values[kept] / trace)


def whiten_embeddings(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row per vector and component.

    Entries become ``x = floor(scale * c)``. Components are unit eigenvectors of the covariance of
    the distinct ``x`` (divisor ``n``), by falling eigenvalue, with their largest entry
    positive. ``whitened`` is the centred ``x`` along a component over the root of its
    eigenvalue; ``deviation`` the squared length of ``n * x - sums``, exactly (null beyond a
    long); ``identity_error`` how far the covariance of ``whitened`` is from the identity.

    Vectors that are null, empty or hold a null, NaN or infinity give no row; nor do those of
    another length than most have (of equally many, the longer). Repeated rows are given back
    each, but count once in the fit; null ids are ids like others. There are fewer components if the
    covariance has fewer that stand out from rounding; none, and no row, for equal vectors.
    Equal eigenvalues leave their order open. Other columns have no influence. No vector, no row.

    Vectors are shuffled once, to find the distinct ones, which are stored; then every pass sends
    on a matrix per task. The fit takes time ``n * width**3`` over all tasks.
    """
    rows = vectors.select("vec_id", scaled(vector, scale).alias("x"))
    kind = T.StructType([
        T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")],
    ])
    nothing = vectors.sparkSession.createDataFrame([], kind)
    widths = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    most = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return nothing
    width = most["width"]
    rows = rows.where(F.size("x") == width)
    fit = store(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, width, components)
    found = model.axes.shape[1]
    if not found:
        return nothing
    covariance = _gram(fit, width, model.project, found) / model.n
    error = float(np.abs(covariance - np.eye(found)).max())
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, width)
            count = len(x)
            each = np.repeat(np.arange(count), found)
            deviations = pa.array(_deviations(model.away(x)), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), count)),
                pa.array(np.full(count * found, model.n)), deviations.take(pa.array(each)),
                pa.array(model.project(x).ravel()), pa.array(np.tile(model.explained, count)),
                pa.array(np.full(count * found, error)),
            ], schema=arrow)

    return rows.mapInArrow(run, kind)

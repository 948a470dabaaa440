"""Whitening of embeddings from exact variances of dimensions and of sums of two dimensions.

Entries are put on a grid of integers. With n vectors and the sum S of a dimension, n * x - S is an integer
too: its squares are added up exactly for every dimension and for the sum of every two dimensions. By
polarisation the covariance of two dimensions is half of what the variance of their sum has over
their own variances. Nothing is rounded before the matrix is handed to the eigensolver.

Tasks hand on one sum per pair of dimensions; the driver holds matrices of dimensions by dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps of the grid in a unit, and what is added so that usual entries are positive.
GRID, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows handled at once inside a task.
BLOCK = 1024
#: Differences below this are squared and added up over a block in 64-bit integers, larger ones in Python's.
_SMALL = 1 << 26
_HALF = 10**28


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors of ``len(sums)`` integers."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    #: Unit eigenvectors as columns and their eigenvalues, largest first; not positive ones are left out.
    vectors: np.ndarray
    values: np.ndarray
    #: Share of the trace, for every component asked for; null without any spread.
    explained: tuple[float | None, ...]
    identity_error: float | None


def on_grid(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, x): rows with a whole vector of finite entries, as integers floor(GRID * c) + SHIFT.

    Where vectors differ in length, those of the most frequent length stay, of the longest one if several are.
    Entries beyond the range of a long are put at its ends. Vectors without entries are left out.
    """
    c = F.col(vector).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = embeddings.select(F.col(key), c.alias("x")).filter((F.size("x") > 0) & finite)
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    least, most = -(2.0**62), 2.0**62
    grid = lambda v: F.least(F.greatest(F.floor(v * GRID).cast("double"), F.lit(least)), F.lit(most)).cast("long") + SHIFT
    rows = rows.filter(F.size("x") == (lengths["dims"] if lengths else 0))
    return rows.select(key, F.transform("x", grid).alias("x"))


def _blocks(batch: pa.RecordBatch, sums: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, n * x - S) of stretches of a batch; Python integers where 64 bits may not hold them."""
    x = batch.column(batch.schema.get_field_index("x"))
    dims = len(sums)
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for at in range(0, len(values), BLOCK):
        part = values[at : at + BLOCK]
        if max(abs(int(part.max())), abs(int(part.min()))) * n + int(abs(sums).max()) < 1 << 62:
            yield at, part * np.int64(n) - sums.astype(np.int64)
        else:
            yield at, part.astype(object) * n - sums


def _square_sums(d: np.ndarray) -> np.ndarray:
    """Exact sums over rows of squares of every d[i] (the diagonal) and of every d[i] + d[j] (above it)."""
    dims = d.shape[1]
    if d.dtype != object and max(-int(d.min()), int(d.max())) >= _SMALL:
        d = d.astype(object)
    out = np.zeros((dims, dims), dtype=object)
    for i in range(dims):
        both = d[:, i : i + 1] + d[:, i:]
        both[:, 0] = d[:, i]
        out[i, i:] = (both * both).sum(axis=0)
    return out


def square_sums(rows: DataFrame, n: int, sums: tuple[int, ...]) -> DataFrame:
    """(i, j, high, low) for i <= j: the sum of (n x_i - S_i)^2 for i = j, else of the square of the two differences'
    sum; in two parts of up to 38 digits, the first in units of ``_HALF``."""
    dims = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), dtype=object)
        totals = np.array(sums, dtype=object)
        for batch in batches:
            for _, d in _blocks(batch, totals, n):
                total += _square_sums(d)
        i, j = np.triu_indices(dims)
        halves = zip(*(divmod(int(v), _HALF) for v in total[i, j]), strict=True)
        exact = [pa.array(map(Decimal, half), pa.decimal128(38, 0)) for half in halves]
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *exact]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "high", "low"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


def covariance_of(totals: np.ndarray, n: int) -> np.ndarray:
    """The covariance matrix from exact sums of squares, each entry rounded once."""
    dims = len(totals)
    out = np.zeros((dims, dims))
    scale = n**3  # squares of n * (x - mean), and the mean of them
    for i in range(dims):
        out[i, i] = float(Fraction(totals[i, i], scale))
        for j in range(i + 1, dims):
            twice = totals[i, j] - totals[i, i] - totals[j, j]
            out[i, j] = out[j, i] = float(Fraction(twice, 2 * scale))
    return out


def _projected(d: np.ndarray, n: int, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (d / n).astype(float) @ vectors / np.sqrt(values)


def _identity_error(rows: DataFrame, n: int, sums: tuple[int, ...], vectors: np.ndarray, values: np.ndarray) -> float | None:
    k = len(values)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        totals = np.array(sums, dtype=object)
        for batch in batches:
            for _, d in _blocks(batch, totals, n):
                w = _projected(d, n, vectors, values)
                first += w.sum(axis=0)
                second += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([[*first, *second.ravel()]], pa.list_(pa.float64()))], names=["moments"])

    parts = rows.select("x").mapInArrow(run, "moments array<double>").select(F.posexplode("moments").alias("at", "v"))
    moments = np.zeros(k + k * k)
    for at, v in parts.groupBy("at").agg(F.sum("v")).collect():
        moments[at] = v / n
    mean, second = moments[:k], moments[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening fitted on all rows of ``on_grid``; null if there are none."""
    entry = F.posexplode("x").alias("at", "v")
    per_dim = rows.select(entry).groupBy("at").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    found = sorted(per_dim.collect())
    if not found:
        return None
    n, sums = found[0]["n"], tuple(int(r["s"]) for r in found)
    dims = len(sums)
    totals = np.zeros((dims, dims), dtype=object)
    for i, j, high, low in square_sums(rows, n, sums).collect():
        totals[i, j] = int(high) * _HALF + int(low)
    covariance = covariance_of(totals, n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    asked = min(components, dims)
    trace = float(np.trace(covariance))
    explained = tuple(max(float(e), 0.0) / trace if trace else None for e in values[:asked])
    positive = int((values[:asked] > dims * np.finfo(float).eps * max(float(values[0]), 0.0)).sum())
    values, vectors = values[:positive].copy(), np.ascontiguousarray(vectors[:, :positive])
    error = _identity_error(rows, n, sums, vectors, values)
    return Whitening(n, sums, covariance, vectors, values, explained, error)


RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: n, exact deviation, whitened value, share of the trace, error of the identity.

    Rows whose vector is null or has null or other than finite entries are left out, see ``on_grid``. ``deviation``
    is the sum over dimensions of (n * x - S)^2, null if it has more than 38 digits. A direction without spread has a null ``whitened``; if there is no
    spread at all ``explained`` and ``identity_error`` are null too. An empty table gives an empty result, repeated
    rows count one by one, other columns are not read.
    """
    rows = on_grid(embeddings, vector, key)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {RESULT}"
    model = fit(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    n, sums, vectors, values = model.n, model.sums, model.vectors, model.values
    explained, error, kept, asked = model.explained, model.identity_error, len(model.values), len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.array(sums, dtype=object)
        for batch in batches:
            for at, d in _blocks(batch, totals, n):
                size = len(d)
                w = np.full((size, asked), np.nan)
                if kept:
                    w[:, :kept] = _projected(d, n, vectors, values)
                wide = d if d.dtype == object or np.abs(d).max() < (1 << 30) // len(sums) else d.astype(object)
                squares = (int(v) for v in (wide * wide).sum(axis=1))
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
                row = pa.array(np.repeat(np.arange(size), asked))
                columns = {
                    key: batch.column(0).slice(at, size).take(row),
                    "component": pa.array(np.tile(np.arange(1, asked + 1), size), pa.int32()),
                    "n": pa.array(np.full(size * asked, n), pa.int64()),
                    "deviation": deviation.take(row),
                    "whitened": pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())),
                    "explained": pa.array(list(explained) * size, pa.float64()),
                    "identity_error": pa.array([error] * (size * asked), pa.float64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(run, schema)

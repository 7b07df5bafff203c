"""Embedding whitening: blockwise QR of the centred rows, singular values by dqds, directions by twisted factorisations.

Entries are taken as integers on a grid, so counts, sums and deviations are exact. No covariance matrix is formed: each
task reduces its centred rows to one triangle, triangles are merged in a tree, and the last one is solved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.bidiagonal import EPS, right_singular
from cohortloom.llm.text import bounded_batches
from cohortloom.llm.tiles import gathered, runs
from cohortloom.runtime import materialize

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
BLOCK_ROWS = 4096
FAN_IN = 16
_EXACT = pa.decimal128(38, 0)
_FAR = float(1 << 62)
_TRIANGLE = "part int, triangle array<double>"


def _grid(vectors: pa.Array, dims: int | None, scale: float, shift: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per number of dimensions (or for one): the places of the vectors that are whole, and floor(scale * c) + shift."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(sizes[sizes > 0]) if dims is None else [dims]:
        at = np.flatnonzero(sizes == size)
        entries = vectors.take(pa.array(at)).flatten()
        entries = entries.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), size)
        whole = np.isfinite(entries).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(entries[whole] * float(scale)), -_FAR, _FAR).astype(np.int64) + shift
        out[int(size)] = at[whole], x
    return out


def _exact_sum(x: np.ndarray) -> list[int]:
    if len(x) and float(np.abs(x.astype(np.float64)).max()) * len(x) < _FAR:
        return x.sum(axis=0).tolist()
    return x.astype(object).sum(axis=0).tolist() if len(x) else [0] * x.shape[1]


def _summed(scale: float, shift: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for size, (at, x) in _grid(batch.column(0), None, scale, shift).items():
                counts[size] = counts.get(size, 0) + len(at)
                sums[size] = [a + b for a, b in zip(sums.get(size, [0] * size), _exact_sum(x))]
        for size, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size] * size, pa.int32()),
                    pa.array(range(size), pa.int32()),
                    pa.array([counts[size]] * size, pa.int64()),
                    pa.array([Decimal(s) for s in total], _EXACT),
                ],
                ["dims", "place", "n", "total"],
            )

    return summed


class Centre:
    """The mean of n integer rows, kept exact as whole part and remainder: S = n * whole + rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.share = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n. The large equal parts cancel as integers, so that only the last rounding is left."""
        return (x - self.whole).astype(np.float64) - self.share

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n x - S)²."""
        y = x - self.whole
        largest = float(np.abs(y.astype(np.float64)).max()) if len(y) else 0.0
        wide = max(largest, 1.0) * max(largest, float(self.n)) * x.shape[1] >= _FAR
        y = y.astype(object) if wide else y
        rest = np.array(self.rest, object if wide else np.int64)
        squares, crossed = (y * y).sum(axis=1).tolist(), (y * rest).sum(axis=1).tolist()
        n, own = self.n, sum(r * r for r in self.rest)
        return [n * n * a - 2 * n * b + own for a, b in zip(squares, crossed)]


def _triangles(centre: Centre, dims: int, scale: float, shift: int, block_rows: int):
    """One triangle for all rows of a task, by the QR of a block of rows below the triangle so far."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle, held, rows = np.zeros((0, dims)), [], 0
        for batch in batches:
            at, x = _grid(batch.column(0), dims, scale, shift)[dims]
            for low in range(0, len(at), block_rows):
                held.append(centre.centred(x[low : low + block_rows]))
                rows += len(held[-1])
                if rows >= block_rows:
                    triangle, held, rows = np.linalg.qr(np.vstack([triangle, *held]), mode="r"), [], 0
        if held:
            triangle = np.linalg.qr(np.vstack([triangle, *held]), mode="r")
        if len(triangle):
            yield _triangle_batch(TaskContext.get().partitionId(), triangle)

    return reduced


def _triangle_batch(part: int, triangle: np.ndarray) -> pa.RecordBatch:
    flat = pa.array([triangle.ravel()], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), flat], ["part", "triangle"])


def _stacked(rows: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.vstack([np.asarray(row.as_py(), np.float64).reshape(-1, dims) for row in rows])


def _merged(dims: int):
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "part"):
            stacked = _stacked(group.column("triangle"), dims)
            yield _triangle_batch(group.column("part")[0].as_py(), np.linalg.qr(stacked, mode="r"))

    return merged


def _solved(dims: int, n: int, k: int):
    """``component``, ``variance``, ``explained`` and ``direction`` of the components, from the one triangle left."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            triangle = np.zeros((dims, dims))
            rows = _stacked(batch.column(batch.schema.get_field_index("triangle")), dims)
            triangle[: len(rows)] = rows
            values, directions = right_singular(triangle, k)
            trace = math.fsum((triangle**2).ravel().tolist())
            # what rounding alone may leave is no variance, and has no direction
            real = values > (8 * dims * EPS) ** 2 * max(float(values[0]), 0.0)
            columns = [
                pa.array(range(1, len(values) + 1), pa.int32()),
                pa.array(np.where(real, values, 0.0) / n, pa.float64()),
                pa.array((values / trace) if trace else [None] * len(values), pa.float64()),
                pa.array(list(directions), pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["component", "variance", "explained", "direction"])

    return solved


def _whitener(components: list, dims: int) -> np.ndarray:
    """Directions over the roots of their variances, as columns; NaN where there is no variance."""
    out = np.array([r["direction"] for r in components]).reshape(len(components), dims)
    roots = np.sqrt([r["variance"] or np.nan for r in components])
    return (out / roots[:, None]).T


def _moments(centre: Centre, whitener: np.ndarray, dims: int, scale: float, shift: int):
    """Count, mean and centred products of the whitened rows of a task, block added to block."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = whitener.shape[1]
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, x = _grid(batch.column(0), dims, scale, shift)[dims]
            if not len(x):
                continue
            white = centre.centred(x) @ whitener
            own = white.mean(axis=0)
            apart, total = own - mean, n + len(white)
            products += (white - own).T @ (white - own) + np.outer(apart, apart) * (n * len(white) / total)
            mean += apart * (len(white) / total)
            n = total
        if n:
            arrays = [pa.array([row], pa.list_(pa.float64())) for row in (mean, products.ravel())]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *arrays], ["n", "mean", "products"])

    return summed


def _identity_error(moments: DataFrame, k: int) -> float | None:
    """Largest entry, by size, of the covariance of the whitened rows minus the identity."""
    spread = moments.select("n", F.posexplode("mean").alias("place", "mean"))
    means = {
        r["place"]: r["mean"]
        for r in spread.groupBy("place").agg((F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mean")).collect()
    }
    if not means:
        return None
    at = F.array(*[F.lit(means[i]) for i in range(k)])
    off = lambda i: F.element_at("mean", i + 1) - F.element_at(at, i + 1)
    cells = moments.select("n", "mean", F.posexplode("products").alias("place", "x"))
    i, j = (F.col("place") / F.lit(k)).cast("int"), F.pmod(F.col("place"), F.lit(k))
    cells = cells.select("n", i.alias("i"), j.alias("j"), (F.col("x") + F.col("n") * off(i) * off(j)).alias("x"))
    covariance = cells.groupBy("i", "j").agg((F.sum("x") / F.sum("n")).alias("x")).filter(~F.isnan("x"))
    return covariance.agg(F.max(F.abs(F.col("x") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]


def fit_whitening(
    df: DataFrame,
    vector: Column,
    components: int = COMPONENTS,
    scale: float = SCALE,
    shift: int = SHIFT,
    block_rows: int = BLOCK_ROWS,
) -> tuple[Centre, list] | None:
    """The exact centre of all whole vectors and their components, largest variance first; none without vectors.

    ``vector`` must be an array of doubles. Vectors of another length than the commonest one play no part. What reaches
    the driver has the size of a vector, times ``components`` at most.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(vector.alias("vector"))
    sums = materialize(
        rows.mapInArrow(_summed(scale, shift), "dims int, place int, n long, total decimal(38,0)")
        .groupBy("dims", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total")),
        "sums",
    )
    most = sums.filter("place = 0 and n > 0").orderBy(F.desc("n"), "dims").first()
    if most is None:
        return None
    dims, n = most["dims"], most["n"]
    centre = Centre(n, [int(r["total"]) for r in sums.filter(F.col("dims") == dims).orderBy("place").collect()])
    parts = materialize(rows.mapInArrow(_triangles(centre, dims, scale, shift, block_rows), _TRIANGLE), "triangles")
    left = parts.agg(F.max("part")).first()[0]
    while left:
        grouped = parts.withColumn("part", (F.col("part") / F.lit(FAN_IN)).cast("int"))
        parts = materialize(gathered(grouped, "part").mapInArrow(_merged(dims), _TRIANGLE), "triangles")
        left //= FAN_IN
    if parts.count() > 1 or left is None:
        raise RuntimeError("the triangles did not merge into one")
    solved = parts.mapInArrow(
        _solved(dims, n, components), "component int, variance double, explained double, direction array<double>"
    )
    return centre, materialize(solved, "components").orderBy("component").collect()


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
    shift: int = SHIFT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector and component: the id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Vectors that are null, empty or hold null or non-finite entries have no rows, nor have those of another length than
    the commonest. Entry c counts as x = floor(``scale`` * c) + ``shift``; entries beyond the range of a long count as
    its ends. Rows that repeat an id or a vector count as rows; a null id stays null. With fewer dimensions than
    ``components`` there are as many components as dimensions. A component without variance (one value only, fewer rows
    than dimensions) has a null ``whitened`` and is left out of ``identity_error``. An empty table gives no rows. Other
    columns of ``df`` play no part. Two components of equal variance may be any orthogonal pair of their plane.
    """
    id_kind = df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_kind),
            *T.StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"),
        ]
    )
    vector = F.col(vector_col).cast("array<double>")
    fitted = fit_whitening(df, vector, components, scale, shift, block_rows)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    centre, found = fitted
    dims, k = len(centre.whole), len(found)
    whitener = _whitener(found, dims)
    rows = df.select(F.col(id_col).alias(id_col), vector.alias("vector"))
    moments = materialize(
        rows.select("vector").mapInArrow(_moments(centre, whitener, dims, scale, shift), "n long, mean array<double>, products array<double>"),
        "moments",
    )
    error = _identity_error(moments, k)
    explained = [r["explained"] for r in found]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _grid(batch.column(1), dims, scale, shift)[dims]
            if not len(at):
                continue
            white = (centre.centred(x) @ whitener).ravel()
            each = np.repeat(np.arange(len(at)), k)
            columns = [
                batch.column(0).take(pa.array(at[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(each), centre.n, np.int64)),
                pa.array([Decimal(v) for v in centre.deviations(x)], _EXACT).take(pa.array(each)),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * len(at), pa.float64()),
                pa.array([error] * len(each), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(projected, schema)

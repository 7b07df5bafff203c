"""Principal components of tall tables of long vectors, without a matrix of columns by columns.

A randomised range finder: a few random directions are multiplied by the data, and back, a pass over the rows each; the
directions so far span a growing space, whose best axes are followed until they settle. A tree of tall-skinny QR steps
makes the last product orthonormal. What a pass takes to the tasks and brings back has the size columns x (k + 10), and
the driver holds some such blocks; rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize

OVERSAMPLE = 10
MAX_ROUNDS = 60
SETTLED = 1e-11  # what is left of an axis after a product, relative to the largest variance
BLOCKS = 12  # of directions held at once
NEGLIGIBLE = 1e-13
FAN_IN = 16
CHUNK_BYTES = 1 << 22
SEED = 42
_PARTS = "part int, place int, values binary"


def _blocks(batches: Iterator[pa.RecordBatch], mean: np.ndarray, scale: np.ndarray) -> Iterator[np.ndarray]:
    """The standardised rows of each batch as a matrix, some at a time."""
    rows = max(1, CHUNK_BYTES // (8 * len(mean)))
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            some = batch.column(0).slice(low, rows)
            yield (some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1) - mean) * scale


def _pieces(part: int, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A matrix in pieces of some rows, a record each."""
    rows = max(1, CHUNK_BYTES // (8 * matrix.shape[1]))
    for place, low in enumerate(range(0, len(matrix), rows)):
        data = np.ascontiguousarray(matrix[low : low + rows]).tobytes()
        columns = [pa.array([part], pa.int32()), pa.array([place], pa.int32()), pa.array([data], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "place", "values"])


def _multiplied(mean: np.ndarray, scale: np.ndarray, directions: np.ndarray, shared):
    """A task's share of Xᵀ (X times the directions)."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = np.zeros(shared.value.shape), False
        for x in _blocks(batches, mean, scale):
            out += x.T @ (x @ shared.value)
            seen = True
        if seen:
            yield from _pieces(0, out @ directions)

    return multiplied


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the pieces of a place; rows come in the order of the places."""
    place, total = None, None
    done = lambda: pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([place], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "place", "values"]
    )
    for batch in batches:
        for at, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            values = np.frombuffer(data)
            if at == place:
                total = total + values
            else:
                if place is not None:
                    yield done()
                place, total = at, values
    if place is not None:
        yield done()


def _triangle(mean: np.ndarray, scale: np.ndarray, shared):
    """One triangle for the products of all rows of a task, by the QR of a block below the triangle so far."""

    def triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, shared.value.shape[1]))
        for x in _blocks(batches, mean, scale):
            held = np.linalg.qr(np.vstack([held, x @ shared.value]), mode="r")
        if len(held):
            yield from _pieces(TaskContext.get().partitionId(), held)

    return triangle


def _merged(width: int):
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for own, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != part and held:
                    yield from _pieces(part, np.linalg.qr(np.vstack(held), mode="r"))
                    held = []
                part = own
                held.append(np.frombuffer(data).reshape(-1, width))
        if held:
            yield from _pieces(part, np.linalg.qr(np.vstack(held), mode="r"))

    return merged


class StandardAxes:
    """Mean and scale of the columns, and the leading axes of the standardised rows with the variances along them."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, axes: np.ndarray, variances: np.ndarray):
        # an axis may point either way: let its largest loading be positive
        largest = np.abs(axes).argmax(axis=0)
        signs = np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        self.mean, self.scale, self.axes, self.variances = mean, scale, axes * signs, variances

    def project(self, df: DataFrame, vector_col: str, output_col: str) -> DataFrame:
        """``df`` with an array of the components in place of the vector."""
        shared = df.sparkSession.sparkContext.broadcast((self.mean, self.scale, self.axes))
        rest = [c for c in df.columns if c != vector_col]
        # the vector comes first, what is kept behind it
        rows = df.select(vector_to_array(vector_col).alias("__x"), *rest)
        kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)

        def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mean, scale, axes = shared.value
            for batch in batches:
                if batch.num_rows:
                    values = np.vstack([x @ axes for x in _blocks(iter([batch]), mean, scale)])
                    made = pa.array(list(values), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*batch.columns[1:], made], [*rest, output_col])

        return rows.mapInArrow(projected, f"{kinds}, `{output_col}` array<double>")


def _orthonormal(block: np.ndarray, held: np.ndarray, least: float) -> np.ndarray:
    """An orthonormal base of what a block adds to the held columns; directions below ``least`` are rounding."""
    for _ in range(2):
        block = block - held @ (held.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > least]
    return np.linalg.qr(u - held @ (held.T @ u))[0]


def _leading(product, columns: int, k: int) -> np.ndarray:
    """Orthonormal directions of which the first ``k`` are the leading axes of a symmetric product."""
    width = min(k + OVERSAMPLE, columns)
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((columns, width)))[0]
    held, products = np.zeros((columns, 0)), np.zeros((columns, 0))
    for _ in range(MAX_ROUNDS):
        products = np.hstack([products, product(block)])
        held = np.hstack([held, block])
        inner = held.T @ products
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        values, turns = values[::-1][:width], turns[:, ::-1][:, :width]
        axes, after = held @ turns, products @ turns
        beyond = after - axes * values
        left = np.linalg.norm(beyond, axis=0)
        if left[:k].max() <= SETTLED * max(values[0], 0) or held.shape[1] == columns:
            break
        if held.shape[1] + width > BLOCKS * width:
            held, products = axes, after
        block = _orthonormal(beyond, held, NEGLIGIBLE * values[0])
        if not block.shape[1]:
            break
    return np.linalg.qr(axes)[0]


def standard_axes(df: DataFrame, vector_col: str, k: int) -> StandardAxes:
    """The ``k`` leading axes of the standardised vectors (a column that never varies counts as zero).

    Directions are added until the axes settle, at most 60 times: that is exact to rounding unless the variances around
    the ``k`` th hardly differ, where any axes of their plane are as good.
    """
    spark = df.sparkSession
    if df.isEmpty():
        raise ValueError("no rows to reduce")
    row = df.agg(Summarizer.metrics("mean", "std", "count").summary(F.col(vector_col)).alias("s")).select("s.*").first()
    mean, std, n = row["mean"].toArray(), row["std"].toArray(), row["count"]
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    rows = df.select(vector_to_array(vector_col).alias("x"))
    columns = len(mean)
    width = min(k + OVERSAMPLE, columns)

    def collected(parts: DataFrame, width: int) -> np.ndarray:
        pieces = sorted((r["place"], bytes(r["values"])) for r in parts.collect())
        return np.frombuffer(b"".join(p for _, p in pieces)).reshape(-1, width)

    def multiplied(directions: np.ndarray, after: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(directions)
        parts = rows.mapInArrow(_multiplied(mean, scale, after, shared), _PARTS)
        dealt = parts.repartition("place").sortWithinPartitions("place")
        out = collected(dealt.mapInArrow(_added, _PARTS), after.shape[1])
        shared.destroy()
        return out

    directions = _leading(lambda v: multiplied(v, np.eye(v.shape[1])), columns, k)
    width = directions.shape[1]
    shared = spark.sparkContext.broadcast(directions)
    parts = materialize(rows.mapInArrow(_triangle(mean, scale, shared), _PARTS), "triangles")
    left = parts.agg(F.max("part")).first()[0]
    while left:
        grouped = parts.withColumn("part", (F.col("part") / F.lit(FAN_IN)).cast("int"))
        dealt = grouped.repartition("part").sortWithinPartitions("part", "place")
        parts = materialize(dealt.mapInArrow(_merged(width), _PARTS), "triangles")
        left //= FAN_IN
    triangle = collected(parts, width)
    # X directions = Q R; what R cannot invert has no variance
    u, s, vt = np.linalg.svd(np.vstack([triangle, np.zeros((width - len(triangle), width))]))
    inverse = vt.T * np.divide(1.0, s, out=np.zeros_like(s), where=s > 1e-14 * max(s[0], 1e-300))
    axes, sizes, _ = np.linalg.svd(multiplied(directions, inverse), full_matrices=False)
    return StandardAxes(mean, scale, axes[:, :k], sizes[:k] ** 2 / max(n - 1, 1))

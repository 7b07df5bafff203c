"""Features as small codes: cut points from mergeable sketches, rows as one byte per feature."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = 255  # the code of a value that is not there
MAX_CUTS = 254
ACCURACY = 100_000


def numeric(features: Sequence[str]) -> list[Column]:
    """The features as doubles; NaN is a missing value."""
    doubles = [F.col(c).cast("double") for c in features]
    return [F.when(~F.isnan(c), c).alias(f"__{i}") for i, c in enumerate(doubles)]


def feature_cuts(df: DataFrame, features: Sequence[str], max_cuts: int = MAX_CUTS) -> list[np.ndarray]:
    """Rising cut points of each feature: a value belongs to the first cut that is not below it, or behind them all.

    A feature of few values is cut at each of them, any other at quantiles. Both come from one aggregate over the table
    (quantile and distinct sketches) and one over the values of the features that have few.
    """
    probs = [(i + 1) / (max_cuts + 1) for i in range(max_cuts)]
    values = df.select(*numeric(features))
    names = values.columns
    sketches = [F.percentile_approx(c, probs, ACCURACY).alias(f"q{c}") for c in names]
    row = values.agg(*sketches, *[F.approx_count_distinct(c, 0.02).alias(f"d{c}") for c in names]).first()
    few = [c for c in names if row[f"d{c}"] <= max_cuts]
    exact: dict[str, list[float]] = {}
    if few:
        pairs = values.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("x")) for c in few])).alias("p"))
        for r in pairs.select("p.*").filter("x is not null").distinct().collect():
            exact.setdefault(r["c"], []).append(r["x"])
    out = []
    for c in names:
        points = np.unique(np.array(exact.get(c) or row[f"q{c}"] or [], np.float64))
        # the largest of all values needs no cut; the sketch's largest may not be the table's
        out.append(points[:-1][:max_cuts] if c in exact else points)
    return out


def coded(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """One row of codes per row of values, NaN as ``MISSING``."""
    out = np.empty((len(columns[0]) if columns else 0, len(cuts)), np.uint8)
    for i, (x, own) in enumerate(zip(columns, cuts)):
        out[:, i] = np.where(np.isnan(x), MISSING, np.searchsorted(own, x, "left"))
    return out


def doubles(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """The first ``n`` columns as doubles, null as NaN."""
    return [batch.column(i).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(n)]


def coded_rows(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """``codes`` (binary, a byte per feature) and the columns ``keep``, whose order stays."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    n = len(features)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = coded(doubles(batch, n), cuts)
            rest = [batch.column(n + i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in codes], pa.binary()), *rest], ["codes", *keep])

    return df.select(*numeric(features), *keep).mapInArrow(encoded, f"codes binary{', ' if kinds else ''}{kinds}")


def code_matrix(column: pa.Array, n: int) -> np.ndarray:
    """Rows of ``codes`` back as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, n)

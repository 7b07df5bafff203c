"""Near-duplicate vectors: spherical k-means deals vectors to cells, cells compare their members in blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.components import FOUND, forest, found_batch, linked_classes
from cohortloom.llm.tiles import gathered, runs
from cohortloom.runtime import ensure_checkpoint_dir, materialize

THRESHOLD = 0.9
CELL_ROWS = 4096
MAX_CELLS = 4096
SAMPLE_ROWS = 100_000
MARGIN = 0.25
BLOCK_ROWS = 2048
VISIT_ROWS = 16_384
# rows of a tile whose cosines are held at once
STRIPE = 256
ROUNDS = 8
SEED = 11
# how far rounding may move a cosine in double precision; closer calls are settled in one fixed order of additions
ROUNDING = 1e-12


def _units(vectors: pa.ListArray) -> np.ndarray:
    """Equally long vectors as rows of length one, in double precision; not finite where a vector cannot be scaled.

    Scaled by the largest component first, so that squares neither overflow nor vanish; a negative zero becomes a zero.
    """
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    with np.errstate(all="ignore"):
        matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True)) + 0.0


def _lengths(vectors: pa.ListArray) -> np.ndarray:
    return vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id``, ``key`` and ``vector``; the key is a digest of the unit vector, null for a vector without one."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = _lengths(vectors)
        keys: list[bytes | None] = [None] * len(sizes)
        for size in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == size)
            units = _units(vectors.take(pa.array(at)))
            for i in np.flatnonzero(np.isfinite(units).all(axis=1)):
                keys[at[i]] = hashlib.blake2b(units[i].tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), vectors], ["id", "key", "vector"])


def _as_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            units = _units(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(units), pa.list_(pa.float64()))], ["unit"])


def fit_cells(distinct: DataFrame, rows: int, cell_rows: int, sample_rows: int) -> np.ndarray | None:
    """Unit centres of spherical k-means on a bounded sample, or none where one cell will do."""
    k = min(MAX_CELLS, rows // cell_rows)
    if k < 2:
        return None
    ensure_checkpoint_dir(distinct.sparkSession)
    if rows > sample_rows:
        distinct = distinct.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(sample_rows / rows * (1 << 30)))
    sample = materialize(
        distinct.select("vector").mapInArrow(_as_units, "unit array<double>").select(array_to_vector("unit").alias("features")),
        "sample",
    )
    model = KMeans(k=k, distanceMeasure="cosine", initMode="random", maxIter=ROUNDS, seed=SEED).fit(sample)
    centres = np.array(model.clusterCenters())
    return centres / np.linalg.norm(centres, axis=1, keepdims=True)


def link_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    cell_rows: int = CELL_ROWS,
    margin: float = MARGIN,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    visit_rows: int = VISIT_ROWS,
) -> DataFrame:
    """One row per row of ``df``: the id, ``n_links`` (other rows at or above the cosine ``threshold``),
    ``component_id`` (least id reachable by links) and ``kept`` (the row's id is its component's).

    Equal vectors are one node with a weight. Every vector has its home in the cell of the nearest centre and visits
    each cell whose centre is at most ``margin`` farther in cosine. A home row is compared with all rows and visitors
    of its cell, in tiles of at most about ``block_rows`` by ``visit_rows``, so its links are counted once. A link is
    missed only if its two vectors lie in different cells and the margin does not reach across; the measured recall is
    in the README. A null vector, a zero one or one with a null or non-finite component links with nothing, as does one
    of another length. Rows that repeat an id count as rows; rows with a null id have a null component and are not
    kept, though they count as links. An empty table gives no rows. Other columns of ``df`` play no part.
    """
    single = df.schema[vector_col].dataType.elementType == T.FloatType()
    kind = "array<float>" if single else "array<double>"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    id_kind = rows.schema["id"].dataType.simpleString()
    keyed = materialize(rows.mapInArrow(_keyed, f"id {id_kind}, key binary, vector {kind}"), "keyed")
    distinct = materialize(
        keyed.filter("key is not null")
        .groupBy("key")
        .agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("least")),
        "vectors",
    )
    most = distinct.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    centres = None
    if most:
        centres = fit_cells(distinct.filter(F.size("vector") == most["dims"]), most["count"], cell_rows, sample_rows)
    tiles = _tiles(distinct, centres, margin, block_rows, visit_rows)
    compared = materialize(gathered(tiles, "tile").mapInArrow(_compared(threshold), FOUND), "found")
    classes = linked_classes(distinct, compared)
    joined = keyed.select("id", "key").join(classes, "key").select("id", "n_links", F.col("root").alias("component_id"))
    alone = keyed.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _in_cells(distinct: DataFrame, centres: np.ndarray | None, margin: float, columns: Sequence[str]) -> DataFrame:
    """``cell`` and ``home`` of every home and visit, with the given columns. Vectors of other lengths are apart."""
    shared = distinct.sparkSession.sparkContext.broadcast(centres)
    kinds = distinct.select(*columns).schema.fields

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            sizes = _lengths(vectors)
            fit = np.flatnonzero(sizes == (-1 if centres is None else centres.shape[1]))
            # cell 0 holds what has no nearest centre: everything without centres, vectors of another length
            row = np.flatnonzero(~np.isin(np.arange(len(sizes)), fit))
            cell, home = np.zeros(len(row), np.int64), np.ones(len(row), bool)
            if len(fit):
                cosines = _units(vectors.take(pa.array(fit))) @ centres.T
                best = cosines.argmax(axis=1)
                near, to = np.nonzero(cosines >= cosines[np.arange(len(fit)), best][:, None] - margin)
                row, cell = np.append(row, fit[near]), np.append(cell, to)
                home = np.append(home, to == best[near])
            take = pa.array(row, pa.int64())
            kept = [batch.column(batch.schema.get_field_index(c)).take(take) for c in columns]
            cells = pa.array([f"{sizes[i]}:{c}" for i, c in zip(row, cell)], pa.string())
            yield pa.RecordBatch.from_arrays([cells, pa.array(home, pa.bool_()), *kept], ["cell", "home", *columns])

    schema = [T.StructField("cell", T.StringType()), T.StructField("home", T.BooleanType()), *kinds]
    return distinct.select("key", "vector", "weight").mapInArrow(dealt, T.StructType(schema))


def _tiles(distinct: DataFrame, centres: np.ndarray | None, margin: float, block_rows: int, visit_rows: int) -> DataFrame:
    """The rows of every ``tile``: ``is_row`` marks home rows of its block, ``is_column`` what they are compared with.

    A cell of h home blocks and v blocks of all its rows has h x v tiles. A row is a column in h of them and, at home,
    a row in v.
    """
    sizes = materialize(
        _in_cells(distinct, centres, margin, [])
        .groupBy("cell")
        .agg(
            F.ceil(F.sum(F.col("home").cast("int")) / F.lit(block_rows)).cast("int").alias("h"),
            F.ceil(F.count(F.lit(1)) / F.lit(visit_rows)).cast("int").alias("v"),
        )
        .filter("h > 0"),
        "sizes",
    )
    placed = _in_cells(distinct, centres, margin, ["key", "vector", "weight"]).join(sizes, "cell")
    placed = placed.withColumn("own_h", F.pmod(F.xxhash64("key"), F.col("h").cast("long")).cast("int"))
    placed = placed.withColumn("own_v", F.pmod(F.xxhash64("key", F.lit(1)), F.col("v").cast("long")).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_column = F.transform(
        upto("h"),
        lambda i: F.struct(
            i.alias("i"), F.col("own_v").alias("j"), (F.col("home") & (i == F.col("own_h"))).alias("is_row"), F.lit(True).alias("is_column")
        ),
    )
    as_row = F.transform(
        F.filter(upto("v"), lambda j: F.col("home") & (j != F.col("own_v"))),
        lambda j: F.struct(F.col("own_h").alias("i"), j.alias("j"), F.lit(True).alias("is_row"), F.lit(False).alias("is_column")),
    )
    spread = placed.select("cell", "key", "vector", "weight", F.explode(F.concat(as_column, as_row)).alias("t"))
    return spread.select(
        F.concat_ws("/", "cell", "t.i", "t.j").alias("tile"), "key", "vector", "weight", "t.is_row", "t.is_column"
    )


def _compared(threshold: float):
    """Per tile: for each of its home rows the weight of its links, and links enough to keep the groups together."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, "tile"):
            tile = tile.combine_chunks()
            keys = np.array(tile.column("key").to_pylist(), dtype=object)
            units = _units(tile.column("vector").chunk(0))
            weight = tile.column("weight").to_numpy()
            rows = np.flatnonzero(tile.column("is_row").to_numpy(zero_copy_only=False))
            columns = np.flatnonzero(tile.column("is_column").to_numpy(zero_copy_only=False))
            counts = np.zeros(len(keys), np.int64)
            peers: list[list[int]] = [[] for _ in keys]
            for low in range(0, len(rows), STRIPE):
                some = rows[low : low + STRIPE]
                linked = near_cosines(units[some], units[columns], threshold)
                linked &= some[:, None] != columns[None, :]
                counts[some] += linked @ weight[columns]
                for i, more in enumerate(forest(linked, some, columns, len(keys))):
                    peers[i] += more
            if (batch := found_batch(keys, counts, peers)) is not None:
                yield batch

    return compared


def near_cosines(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two unit matrices reach the threshold; calls within rounding are summed again one by one."""
    products = a @ b.T
    linked = products >= threshold
    for i, j in zip(*np.nonzero(np.abs(products - threshold) < ROUNDING)):
        linked[i, j] = sum(float(x) * float(y) for x, y in zip(a[i], b[j])) >= threshold
    return linked

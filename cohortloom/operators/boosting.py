"""Gradient-boosted trees with second-order gain and learned directions for missing values.

Rows that agree in the codes of all features share their score in every round, so a grouped aggregate first turns rows
into weighted cells. A level of a tree is one aggregate over the cells: gradients and hessians are summed per (node,
feature, bin), first within each task, then by the driver or, where there are many sums, per feature, where the best split
of each node is found.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.binning import MISSING, code_matrix, coded, coded_rows, feature_cuts, numeric
from cohortloom.runtime import materialize, remove_path, scratch_path

# Boosting parameters.
BOOSTING = {"max_depth": 5, "eta": 0.05, "n_estimators": 300}
LAMBDA = 1.0
MIN_HESSIAN = 1.0
MIN_GAIN = 1e-6
# gains that agree to this many digits are ties, which go to the first feature, then the lowest cut
TIE_DIGITS = 10
# cells that one task may hold; up to these all rounds are one task's, beyond them each level is a job
TASK_CELLS = 1 << 16
TASK_CODES = 1 << 24  # codes of all cells and features together that it may hold
HISTOGRAM_BYTES = 1 << 26  # sums that a task holds at once; a wide table is summed some features at a time
ROUNDS_PER_TABLE = 10
_CODES = 256
_SPLIT = "node int, gain double, feature int, cut int, missing_left boolean, gl double, hl double, gr double, hr double"


@dataclass(frozen=True)
class Split:
    node: int
    gain: float
    feature: int
    cut: int
    missing_left: bool
    gl: float
    hl: float
    gr: float
    hr: float


class Tree:
    """Nodes in the order they were made; ``left`` is -1 for a leaf."""

    def __init__(self):
        self.feature, self.cut, self.missing_left, self.left, self.value, self.gain = [], [], [], [], [], []

    def add(self, value: float) -> int:
        for column, x in zip((self.feature, self.cut, self.missing_left, self.left, self.value, self.gain), (0, 0, False, -1, value, 0.0)):
            column.append(x)
        return len(self.left) - 1

    def split(self, best: Split, left_value: float, right_value: float) -> tuple[int, int]:
        at = best.node
        self.feature[at], self.cut[at], self.missing_left[at], self.gain[at] = best.feature, best.cut, best.missing_left, best.gain
        self.left[at] = self.add(left_value)
        return self.left[at], self.add(right_value)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node in which each row of codes ends."""
        feature, cut, left = (np.array(x, np.int64) for x in (self.feature, self.cut, self.left))
        missing_left = np.array(self.missing_left, bool)
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while True:
            on = left[at] >= 0
            if not on.any():
                return at
            own = codes[rows, feature[at]]
            goes_left = np.where(own == MISSING, missing_left[at], own <= cut[at])
            at = np.where(on, left[at] + ~goes_left, at)

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(codes)]


def _weights(n: np.ndarray, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the logistic loss of cells of ``n`` rows, ``y`` of them positive."""
    p = 1 / (1 + np.exp(-score))
    return n * p - y, n * p * (1 - p)


def _histograms(
    codes: np.ndarray, nodes: np.ndarray, wanted: Sequence[int], g: np.ndarray, h: np.ndarray, features: Sequence[int]
) -> np.ndarray:
    """Sums of g and h by feature (of those given), wanted node and code."""
    place = np.full(int(nodes.max(initial=0)) + 1, -1)
    known = [w for w in wanted if w < len(place)]
    place[known] = [list(wanted).index(w) for w in known]
    own = place[nodes]
    rows = np.flatnonzero(own >= 0)
    size = len(wanted) * _CODES
    out = np.zeros((len(features), 2, size))
    for i, f in enumerate(features):
        at = own[rows] * _CODES + codes[rows, f]
        out[i, 0], out[i, 1] = (np.bincount(at, w[rows], size) for w in (g, h))
    return out.reshape(len(features), 2, len(wanted), _CODES)


def _feature_blocks(width: int, nodes: int) -> list[range]:
    """The features in runs whose sums over so many nodes a task can hold."""
    block = max(1, HISTOGRAM_BYTES // (nodes * _CODES * 16))
    return [range(low, min(low + block, width)) for low in range(0, width, block)]


def _best_split(feature: int, node: int, g: np.ndarray, h: np.ndarray) -> Split:
    """The best cut of one node by one feature, with the missing values on the better side.

    Where none gains enough the gain is 0, and all of the node counts as its left side.
    """
    total_g, total_h = float(g.sum()), float(h.sum())
    gl, hl = np.cumsum(g[:MISSING]), np.cumsum(h[:MISSING])
    # the first row sends missing values right, the second left
    gl, hl = np.stack([gl, gl + g[MISSING]]), np.stack([hl, hl + h[MISSING]])
    gr, hr = total_g - gl, total_h - hl
    gain = gl**2 / (hl + LAMBDA) + gr**2 / (hr + LAMBDA) - total_g**2 / (total_h + LAMBDA)
    gain = np.where((hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN), gain, -1.0)
    best = float(gain.max())
    if best <= MIN_GAIN:
        return Split(node, 0.0, feature, MISSING, True, total_g, total_h, 0.0, 0.0)
    side, cut = np.unravel_index(int((np.round(gain / best, TIE_DIGITS) >= 1).argmax()), gain.shape)
    at = (side, cut)
    return Split(node, best, feature, int(cut), bool(side), *(float(x[at]) for x in (gl, hl, gr, hr)))


def _better(found: Sequence[Split]) -> dict[int, Split]:
    """The best split of each node; ties go to the first feature."""
    out: dict[int, Split] = {}
    for s in sorted(found, key=lambda s: s.feature):
        held = out.get(s.node)
        if held is None or s.gain > 0 and (held.gain == 0 or round(s.gain / held.gain, TIE_DIGITS) > 1):
            out[s.node] = s
    return out


def _grow(depth: int, eta: float, best_splits: Callable[[Tree, list[int]], dict[int, Split]]) -> Tree:
    """One tree, level by level; ``best_splits`` finds those of the nodes of a level. Without any it is one leaf."""
    tree = Tree()
    level = [tree.add(0.0)]
    leaf = lambda g, h: -eta * g / (h + LAMBDA)
    for step in range(depth):
        found = best_splits(tree, level)
        if step == 0 and not found[0].gain:
            tree.value[0] = leaf(found[0].gl, found[0].hl)
        level = [child for s in found.values() if s.gain for child in tree.split(s, leaf(s.gl, s.hl), leaf(s.gr, s.hr))]
        if not level:
            break
    return tree


def _fit_in_task(codes: np.ndarray, n: np.ndarray, y: np.ndarray, start: float, rounds: int, depth: int, eta: float) -> list[Tree]:
    score, trees = np.full(len(n), start), []
    for _ in range(rounds):
        g, h = _weights(n, y, score)

        def best_splits(tree, level, g=g, h=h):
            nodes, found = tree.nodes(codes), []
            for features in _feature_blocks(codes.shape[1], len(level)):
                sums = _histograms(codes, nodes, level, g, h, features)
                found += [_best_split(f, node, *sums[i, :, k]) for i, f in enumerate(features) for k, node in enumerate(level)]
            return _better(found)

        trees.append(_grow(depth, eta, best_splits))
        score += trees[-1].values(codes)
    return trees


_BLOCK = "codes binary, n binary, y binary, score binary"
Cells = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # codes, rows, positives, score


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of a batch as one row."""
    for batch in batches:
        if batch.num_rows:
            numbers = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for i in (1, 2, 3)]
            packed = [b"".join(batch.column(0).to_pylist()), *numbers]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], ["codes", "n", "y", "score"])


def _cells_of(block: Row, width: int) -> Cells:
    return np.frombuffer(block[0], np.uint8).reshape(-1, width), *[np.frombuffer(x) for x in block[1:]]


def _rescored(width: int, recent: Sequence[Tree]):
    def rescored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = []
            for block in zip(*[c.to_pylist() for c in batch.columns]):
                codes, _, _, before = _cells_of(block, width)
                score.append(sum((t.values(codes) for t in recent), before).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score, pa.binary())], batch.schema.names)

    return rescored


def _moved(tree: Tree):
    """The cells with the scores that one more tree gives them."""
    return lambda cells: (*cells[:3], cells[3] + tree.values(cells[0]))


def _summed(tree: Tree, level: Sequence[int], features: Sequence[int]):
    """A task's histograms of some features."""

    def summed(blocks: Iterator[Cells]) -> Iterator[tuple[int, np.ndarray]]:
        total = None
        for codes, n, y, score in blocks:
            sums = _histograms(codes, tree.nodes(codes), level, *_weights(n, y, score), features)
            total = sums if total is None else total + sums
        return iter(() if total is None else zip(features, total))

    return summed


def _searched(level: Sequence[int]):
    """The best split of each node among some features."""

    def searched(sums: Iterator[tuple[int, np.ndarray]]) -> list[Split]:
        return list(_better([_best_split(f, node, *own[:, k]) for f, own in sums for k, node in enumerate(level)]).values())

    return searched


def _fit_by_levels(cells: DataFrame, width: int, start: float, rounds: int, depth: int, eta: float) -> list[Tree]:
    """A job per level over cells that stay with the executors; every few rounds the scores are written.

    A job has one stage as long as the driver can add the sums of its tasks; otherwise they are added by feature.
    """
    spark = cells.sparkSession
    blocks = materialize(cells.withColumn("score", F.lit(start)).mapInArrow(_blocks, _BLOCK), "cells")

    def kept(blocks: DataFrame) -> RDD:
        return blocks.rdd.map(lambda block: _cells_of(block, width)).persist(StorageLevel.MEMORY_AND_DISK)

    held = kept(blocks)
    parts = held.getNumPartitions()
    trees: list[Tree] = []
    recent: list[Tree] = []
    path = None
    now, older = held, []
    for _ in range(rounds):

        def best_splits(tree, level, now=now):
            search, found = _searched(level), []
            for features in _feature_blocks(width, len(level)):
                sums = now.mapPartitions(_summed(tree, level, features))
                if parts * len(features) * len(level) * _CODES * 16 <= HISTOGRAM_BYTES:
                    total: dict[int, np.ndarray] = {}
                    for f, own in sums.collect():
                        total[f] = total[f] + own if f in total else own
                    found += search(total.items())
                else:
                    found += sums.reduceByKey(operator.add, min(len(features), parts)).mapPartitions(search).collect()
            return _better(found)

        trees.append(_grow(depth, eta, best_splits))
        recent.append(trees[-1])
        older.append(now)
        now = now.map(_moved(trees[-1])).persist(StorageLevel.MEMORY_AND_DISK)
        if len(older) > 1:
            older.pop(0).unpersist()
        if len(recent) == ROUNDS_PER_TABLE:
            before, path = path, scratch_path(spark, "cells")
            blocks.mapInArrow(_rescored(width, tuple(recent)), _BLOCK).write.parquet(path)
            for rdd in (*older, now):
                rdd.unpersist()
            blocks, recent, older = spark.read.schema(_BLOCK).parquet(path), [], []
            now = kept(blocks)
            parts = now.getNumPartitions()
            if before:
                remove_path(spark, before)
    for rdd in (*older, now):
        rdd.unpersist()
    return trees


@dataclass(frozen=True)
class BoostedTrees:
    """Trees over the codes of features, the score before the first of them, and the features' cut points."""

    trees: tuple[Tree, ...]
    start: float
    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]

    def probability(self, features: Sequence[str] | None = None) -> Column:
        """The probability of the outcome as a column over the features (or others in their place)."""
        trees, start, cuts = self.trees, self.start, self.cuts

        @F.pandas_udf("double")
        def scored(columns: pd.DataFrame) -> pd.Series:
            codes = coded([columns[c].to_numpy(np.float64, na_value=np.nan) for c in columns], cuts)
            return pd.Series(1 / (1 + np.exp(-start - sum((t.values(codes) for t in trees), np.zeros(len(codes))))))

        return scored(F.struct(*numeric(features or self.features)))

    def importances(self) -> list[float]:
        """Mean gain of the splits by each feature, as shares of one; zeros if there are none."""
        gains, counts = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            for f, left, gain in zip(tree.feature, tree.left, tree.gain):
                if left >= 0:
                    gains[f] += gain
                    counts[f] += 1
        mean = gains / np.maximum(counts, 1)
        return (mean / mean.sum() if mean.sum() else mean).tolist()

    def write(self, spark: SparkSession, path: str) -> None:
        """One row per tree, and one that describes the rest."""
        rest = json.dumps({"start": self.start, "features": self.features, "cuts": [c.tolist() for c in self.cuts]})
        rows = [(-1, rest), *[(i, json.dumps(vars(t))) for i, t in enumerate(self.trees)]]
        spark.createDataFrame(rows, "place int, described string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> BoostedTrees:
        first, *rows = [json.loads(r["described"]) for r in spark.read.parquet(path).orderBy("place").collect()]
        trees = []
        for row in rows:
            trees.append(Tree())
            vars(trees[-1]).update(row)
        return cls(tuple(trees), first["start"], tuple(first["features"]), tuple(np.array(c) for c in first["cuts"]))


def train_boosted_classifier(
    train: DataFrame,
    feature_cols: Sequence[str],
    target_col: str = "event",
    params: dict | None = None,
    task_cells: int = TASK_CELLS,
) -> BoostedTrees:
    """Boosted trees with logistic loss for a 0/1 target; rows without a target play no part.

    A split gains GL²/(HL + 1) + GR²/(HR + 1) - G²/(H + 1) and needs a hessian of one on either side; a leaf adds
    -eta G/(H + 1). Values that are
    null or NaN go to the side of each split that gains more. The score starts with one Newton step from zero. Features
    have up to 255 bins. Up to ``task_cells`` distinct rows of codes (and ``TASK_CODES`` codes) are boosted by one task; the
    result is the same.
    """
    chosen = {**BOOSTING, **(params or {})}
    settings = chosen["n_estimators"], chosen["max_depth"], chosen["eta"]
    known = train.filter(F.col(target_col).isNotNull())
    cuts = feature_cuts(known, feature_cols)
    labelled = known.withColumn("__y", F.col(target_col).cast("long"))
    grouped = coded_rows(labelled, feature_cols, cuts, ["__y"]).groupBy("codes")
    cells = materialize(grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("y")), "cells")
    size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    if not size["cells"]:
        raise ValueError("no row with a target to train on")
    start = 4 * size["y"] / size["n"] - 2
    width = len(feature_cols)
    if size["cells"] > task_cells or size["cells"] * width > TASK_CODES:
        trees = _fit_by_levels(cells, width, start, *settings)
    else:

        def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = pa.Table.from_batches(batches).combine_chunks()
            codes = code_matrix(held.column(0), width)
            n, y = (held.column(i).to_numpy().astype(np.float64) for i in (1, 2))
            made = [json.dumps(vars(t)) for t in _fit_in_task(codes, n, y, start, *settings)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int32()), pa.array(made, pa.string())], ["place", "tree"])

        together = cells.coalesce(1).sortWithinPartitions("codes").mapInArrow(fitted, "place int, tree string")
        trees = []
        for r in sorted(together.collect()):
            trees.append(Tree())
            vars(trees[-1]).update(json.loads(r["tree"]))
    return BoostedTrees(tuple(trees), start, tuple(feature_cols), tuple(cuts))

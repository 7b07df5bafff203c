"""A random survival forest: log-rank splits, Nelson-Aalen leaves, a scalar risk per leaf.

Rows become codes, the number of event times at which they are at risk, and whether the last of these is their event;
equal rows are one weighted cell. Every tree draws from the cells by a hash, so a repeated task draws alike, and a draw
is bounded, so that one task can hold it. The trees are a table with a row each, and are followed a bounded chunk at a
time.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.binning import MISSING, code_matrix, coded, coded_rows, feature_cuts, numeric
from cohortloom.runtime import materialize

# Forest parameters.
FOREST_TREES = 300
FOREST_MIN_LEAF = 10
SEED = 42
FOREST_CUTS = 63
MAX_TIMES = 4096  # event times are told apart up to this many, then by quantiles
MAX_SAMPLES = 1_000_000  # rows that a tree draws at most, on average
CHUNK_NODES = 2_000_000
TIE_DIGITS = 10
_DRAWN = "tree int, codes binary, risk_times binary, event binary, draws binary"
_TREES = (
    "tree int, feature array<int>, cut array<int>, missing_left array<boolean>, left array<int>, risk array<double>, "
    "times array<array<int>>, hazards array<array<double>>"
)


def event_times(df: DataFrame, duration_col: str, event_col: str, max_times: int = MAX_TIMES) -> np.ndarray:
    """The distinct event times, or as many quantiles of them, the last of all among them."""
    events = df.filter(F.col(event_col) == 1).select(F.col(duration_col).cast("double").alias("t")).filter("t is not null")
    few = [r["t"] for r in events.distinct().limit(max_times + 1).collect()]
    if len(few) > max_times:
        probs = [(i + 1) / max_times for i in range(max_times)]
        few = events.agg(F.percentile_approx("t", probs, 10 * max_times), F.max("t")).first()
        few = [*few[0], few[1]]
    return np.unique(np.array(few, np.float64))


def _placed(df: DataFrame, duration_col: str, event_col: str, times: np.ndarray) -> DataFrame:
    """``__risk``: at how many of the event times a row is at risk. An event counts at the first time not before it."""
    grid = times

    @F.pandas_udf("int")
    def at_risk(duration: pd.Series, event: pd.Series) -> pd.Series:
        t = duration.to_numpy(np.float64)
        counted = np.searchsorted(grid, t, "right")
        return pd.Series(np.where(event.to_numpy() == 1, np.searchsorted(grid, t, "left") + 1, counted).astype(np.int32))

    event = (F.col(event_col) == 1).cast("int")
    return df.withColumn("__event", event).withColumn("__risk", at_risk(F.col(duration_col).cast("double"), "__event"))


def _poisson(u: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Poisson draws of the given rates at the quantiles ``u``."""
    out = np.zeros(len(u), np.int64)
    for r in np.unique(rate):
        top = int(r + 12 * math.sqrt(r) + 20)
        logs = np.cumsum(np.log(np.arange(1, top + 1)))
        mass = np.exp(-r + np.arange(1, top + 1) * math.log(r) - logs)
        cumulated = math.exp(-r) + np.append(0, np.cumsum(mass))
        mine = rate == r
        out[mine] = np.searchsorted(cumulated, u[mine], "left")
    return out


def _uniform(keys: np.ndarray, tree: int) -> np.ndarray:
    x = keys + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _drawn(width: int, trees: int, rate: float, bootstrap: bool):
    """What each tree draws from the cells of a batch, a row per tree."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = code_matrix(batch.column(0), width)
            risk, event, n, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            rows = []
            for tree in range(trees):
                draws = _poisson(_uniform(keys.view(np.uint64), tree), n * rate) if bootstrap else n
                at = np.flatnonzero(draws)
                packed = (risk[at].astype("<i4"), event[at].astype("u1"), draws[at].astype("<i8"))
                rows.append((tree, codes[at].tobytes(), *(x.tobytes() for x in packed)))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            names = [part.split()[0] for part in _DRAWN.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return drawn


def log_rank(codes: np.ndarray, risk: np.ndarray, event: np.ndarray, weight: np.ndarray, min_leaf: int) -> tuple[float, int, bool] | None:
    """The best cut of a node by one feature: the statistic, the cut, and whether missing values go left."""
    node = _Node(risk, event, weight)
    return node.best_cut(codes, min_leaf) if len(node.times) else None


class _Node:
    """The rows of a node by event time, for the cuts of any feature."""

    def __init__(self, risk: np.ndarray, event: np.ndarray, weight: np.ndarray):
        self.died = np.flatnonzero(event)
        self.times = np.unique(risk[self.died])
        self.until = np.searchsorted(self.times, risk, "right")
        self.weight, self.deaths, self.total = weight, weight[self.died], float(weight.sum())

    def _by_time(self, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Deaths and numbers at risk by group and event time."""
        width = len(self.times) + 1
        at = group * width + self.until
        leaves = np.bincount(at, self.weight, groups * width).reshape(groups, width)
        deaths = np.bincount(at[self.died] - 1, self.deaths, groups * width).reshape(groups, width)
        return deaths[:, :-1], leaves[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]

    def best_cut(self, codes: np.ndarray, min_leaf: int) -> tuple[float, int, bool] | None:
        """Deaths and numbers at risk are counted per (code, event time) once; running sums over the codes give the left
        side of every cut, running sums from the last time the numbers at risk. Codes between which no cut leaves
        enough on either side count as one.
        """
        n = np.bincount(codes, self.weight, MISSING + 1)
        bins = np.flatnonzero(np.bincount(codes, minlength=MISSING + 1))
        missing = bool(bins[-1] == MISSING)
        known = bins[: len(bins) - missing]
        if len(bins) < 2:
            return None
        left_n = n[known].cumsum()
        # with the missing values on the right, then on the left; without any, the last cut cuts nothing
        fits = [(count >= min_leaf) & (self.total - count >= min_leaf) for count in ((left_n, left_n + n[MISSING]) if missing else (left_n,))]
        cuts = np.flatnonzero(fits[0] | fits[1] if missing else fits[0])
        if not len(cuts):
            return None
        # a group of codes up to each cut that fits, one beyond them all, and one of the missing values
        place = np.searchsorted(known[cuts], np.arange(MISSING + 1))
        place[MISSING] = len(cuts) + 1
        deaths, at_risk = self._by_time(place[codes], len(cuts) + 2)
        total_d, total_y = deaths.sum(axis=0), at_risk.sum(axis=0)
        left_d, left_y = deaths[:-2].cumsum(axis=0), at_risk[:-2].cumsum(axis=0)
        spread = total_d * (total_y - total_d) / np.maximum(total_y - 1, 1)
        best = None
        for side, fit in enumerate(fits):
            d, y = (left_d + deaths[-1], left_y + at_risk[-1]) if side else (left_d, left_y)
            share = y / total_y
            excess = (d - share * total_d).sum(axis=1)
            variance = (spread * share * (1 - share)).sum(axis=1)
            good = fit[cuts] & (variance > 1e-12)
            if good.any():
                statistic = np.where(good, np.abs(excess) / np.sqrt(np.where(good, variance, 1.0)), -1.0)
                top = float(statistic.max())
                if top > 0 and (best is None or round(top / best[0], TIE_DIGITS) > 1):
                    first = int((np.round(statistic / top, TIE_DIGITS) >= 1).argmax())
                    best = top, int(known[cuts[first]]), bool(side)
        return best


def nelson_aalen(risk: np.ndarray, event: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Event times (as numbers of times at risk) and the hazard added at each."""
    times = np.unique(risk[event > 0])
    until = np.searchsorted(times, risk, "right")
    leaves = np.bincount(until, weight, len(times) + 1)
    at_risk = np.cumsum(leaves[::-1])[::-1][1:]
    died = event > 0
    deaths = np.bincount(until[died] - 1, weight[died], len(times))
    return times, deaths / at_risk


def _leaf_hazards(leaf: np.ndarray, leaves: int, risk: np.ndarray, event: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`nelson_aalen` of all leaves at once: times, hazards, and where each leaf's begin."""
    order = np.lexsort((risk, leaf))
    leaf, risk, weight = leaf[order], risk[order], weight[order]
    died = np.flatnonzero(event[order])
    pairs = leaf[died] * (int(risk.max(initial=0)) + 1) + risk[died]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
    deaths = np.add.reduceat(weight[died], first) if len(first) else np.zeros(0)
    own, times = leaf[died[first]], risk[died[first]]
    # at risk: all of the leaf from the first row at risk this long to its end
    begins = np.searchsorted(leaf * (int(risk.max(initial=0)) + 1) + risk, pairs[first])
    before = np.append(0.0, np.cumsum(weight))
    ends = np.searchsorted(leaf, own, "right")
    return times, deaths / (before[ends] - before[begins]), np.searchsorted(own, np.arange(leaves + 1))


def grow_tree(codes: np.ndarray, risk: np.ndarray, event: np.ndarray, weight: np.ndarray, last: int, min_leaf: int, draw: np.random.Generator) -> dict:
    """One tree. A node looks at the root of the number of features, and on until one of them splits it."""
    width = codes.shape[1]
    tries = max(1, int(math.sqrt(width)))
    by_feature = np.ascontiguousarray(codes.T)
    tree: dict[str, list] = {k: [] for k in ("feature", "cut", "missing_left", "left", "risk", "times", "hazards")}

    def add() -> int:
        for column, x in zip(tree.values(), (0, 0, False, -1, 0.0, [], [])):
            column.append(x)
        return len(tree["left"]) - 1

    leaf_of = np.zeros(len(risk), np.int64)
    open_nodes = [(add(), np.arange(len(risk)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        leaf_of[rows] = node
        own_weight, own_event = weight[rows], event[rows]
        if own_weight.sum() < 2 * min_leaf or not own_event.any():
            continue
        inside = _Node(risk[rows], own_event, own_weight)
        best = None
        for looked, f in enumerate(draw.permutation(width)):
            if looked >= tries and best is not None:
                break
            found = inside.best_cut(by_feature[f][rows], min_leaf)
            if found is not None and (best is None or round(found[0] / best[1][0], TIE_DIGITS) > 1):
                best = int(f), found
        if best is None:
            continue
        f, (_, cut, missing_left) = best
        x = by_feature[f][rows]
        goes_left = np.where(x == MISSING, missing_left, x <= cut)
        tree["feature"][node], tree["cut"][node], tree["missing_left"][node] = f, cut, missing_left
        left = add()
        tree["left"][node] = left
        open_nodes += [(left, rows[goes_left]), (add(), rows[~goes_left])]
    # only leaves are asked for their risk and hazards
    times, hazards, begins = _leaf_hazards(leaf_of, len(tree["left"]), risk, event, weight)
    for node, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
        if a < b:
            tree["risk"][node] = float((hazards[a:b] * (last + 1 - times[a:b])).sum())
            tree["times"][node], tree["hazards"][node] = times[a:b].tolist(), hazards[a:b].tolist()
    return tree


def _grown(width: int, last: int, min_leaf: int, seed: int):
    def grown(key: tuple[pa.Scalar, ...], drawn: pa.Table) -> pa.Table:
        number = key[0].as_py()
        joined = {c: b"".join(drawn.column(c).to_pylist()) for c in drawn.column_names if c != "tree"}
        codes = np.frombuffer(joined["codes"], np.uint8).reshape(-1, width)
        risk = np.frombuffer(joined["risk_times"], "<i4").astype(np.int64)
        event = np.frombuffer(joined["event"], "u1")
        draws = np.frombuffer(joined["draws"], "<i8").astype(np.float64)
        # the order of the rows must not depend on the shuffle
        order = np.lexsort((draws, event, risk, *codes.T))
        tree = grow_tree(codes[order], risk[order], event[order], draws[order], last, min_leaf, np.random.default_rng((seed, number)))
        return pa.table({"tree": pa.array([number], pa.int32()), **{c: pa.array([v], _KINDS[c]) for c, v in tree.items()}})

    return grown


_KINDS = {
    "feature": pa.list_(pa.int32()), "cut": pa.list_(pa.int32()), "missing_left": pa.list_(pa.bool_()), "left": pa.list_(pa.int32()),
    "risk": pa.list_(pa.float64()), "times": pa.list_(pa.list_(pa.int32())), "hazards": pa.list_(pa.list_(pa.float64())),
}


def _leaf(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, missing_left: np.ndarray, left: np.ndarray) -> np.ndarray:
    at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while len(rows := rows[left[at[rows]] >= 0]):
        node = at[rows]
        x = codes[rows, feature[node]]
        at[rows] = left[node] + ~np.where(x == MISSING, missing_left[node], x <= cut[node])
    return at


@dataclass(frozen=True)
class SurvivalForest:
    """The trees as a written table, and what is needed to read rows as they do."""

    trees: DataFrame
    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]
    times: tuple[float, ...]

    def write(self, spark: SparkSession, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        rest = json.dumps({"features": self.features, "cuts": [c.tolist() for c in self.cuts], "times": self.times})
        spark.createDataFrame([(rest,)], "description string").coalesce(1).write.mode("overwrite").parquet(f"{path}/description")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> SurvivalForest:
        rest = json.loads(spark.read.parquet(f"{path}/description").first()[0])
        cuts = tuple(np.array(c) for c in rest["cuts"])
        return cls(spark.read.parquet(f"{path}/trees"), tuple(rest["features"]), cuts, tuple(rest["times"]))

    def leaves(self) -> DataFrame:
        """``tree``, ``node``, ``risk`` and, along the event times, the cumulative hazard of every leaf."""
        nodes = self.trees.select("tree", F.posexplode(F.arrays_zip("left", "risk", "times", "hazards")).alias("node", "n"))
        steps = nodes.filter("n.left < 0").select("tree", "node", "n.risk", F.posexplode_outer(F.arrays_zip("n.times", "n.hazards")).alias("step", "s"))
        times = F.array(*[F.lit(float(t)) for t in self.times])
        collected = steps.groupBy("tree", "node", "risk").agg(
            F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), F.struct(F.element_at(times, F.col("s.times")).alias("time"), F.col("s.hazards").alias("hazard"))))).alias("steps")
        )
        running = F.aggregate(
            "steps",
            F.array().cast("array<struct<time: double, cumulative: double>>"),
            lambda done, x: F.concat(
                done,
                F.array(F.struct(x["time"].alias("time"), (F.coalesce(F.get(done, F.size(done) - 1)["cumulative"], F.lit(0.0)) + x["hazard"]).alias("cumulative"))),
            ),
        )
        return collected.select("tree", "node", "risk", running.alias("cumulative_hazard"))

    def risk(self, df: DataFrame, output_col: str = "risk", chunk_nodes: int = CHUNK_NODES) -> DataFrame:
        """Add the cumulative hazard, summed over the event times and averaged over the trees: the higher, the earlier
        the event. Every row is scored once per chunk of trees; a chunk has a bounded number of nodes."""
        sizes = self.trees.select("tree", F.size("left").alias("nodes")).orderBy("tree").collect()
        chunks, held = [[]], 0
        for r in sizes:
            if chunks[-1] and held + r["nodes"] > chunk_nodes:
                chunks.append([])
                held = 0
            chunks[-1].append(r["tree"])
            held += r["nodes"]
        scored = df.withColumn("__sum", F.lit(0.0))
        for chunk in chunks:
            more = (F.col("__sum") + self._chunk_risk(df.sparkSession, chunk)).alias("__sum")
            scored = scored.select(*df.columns, more)
            if len(chunks) > 1:
                scored = materialize(scored, "scored")
        return scored.select(*df.columns, (F.col("__sum") / len(sizes)).alias(output_col))

    def _chunk_risk(self, spark: SparkSession, chunk: Sequence[int]):
        kinds = {"feature": np.int32, "cut": np.int32, "missing_left": bool, "left": np.int64, "risk": np.float64}
        rows = self.trees.filter(F.col("tree").between(min(chunk), max(chunk))).select("tree", *kinds).toArrow().sort_by("tree")
        shared = spark.sparkContext.broadcast(
            [{c: rows.column(c)[i].values.to_numpy(zero_copy_only=False).astype(k) for c, k in kinds.items()} for i in range(rows.num_rows)]
        )
        cuts = self.cuts

        @F.pandas_udf("double")
        def summed(columns: pd.DataFrame) -> pd.Series:
            codes = coded([columns[c].to_numpy(np.float64, na_value=np.nan) for c in columns], cuts)
            out = np.zeros(len(codes))
            for t in shared.value:
                out += t["risk"][_leaf(codes, t["feature"], t["cut"], t["missing_left"], t["left"])]
            return pd.Series(out)

        return summed(F.struct(*numeric(self.features)))


def train_survival_forest(
    train: DataFrame,
    duration_col: str,
    event_col: str,
    covariate_cols: Sequence[str],
    n_estimators: int = FOREST_TREES,
    min_leaf: int = FOREST_MIN_LEAF,
    max_cuts: int = FOREST_CUTS,
    max_times: int = MAX_TIMES,
    max_samples: int = MAX_SAMPLES,
    bootstrap: bool = True,
    seed: int = SEED,
) -> SurvivalForest:
    """A forest of trees that split where the log-rank statistic is largest, down to ``min_leaf`` draws on either side.

    Rows without a duration or event play no part; missing covariates go to the better side of each split. A tree draws
    every row a Poisson(1) number of times, by a hash of the row (equal rows share their draws), or fewer so that about
    ``max_samples`` rows are drawn. Covariates have up to ``max_cuts`` cuts. ``bootstrap=False`` takes every row once.
    """
    known = train.dropna(subset=[duration_col, event_col])
    times = event_times(known, duration_col, event_col, max_times)
    if not len(times):
        raise ValueError("no event to learn from")
    cuts = feature_cuts(known, covariate_cols, max_cuts)
    placed = coded_rows(_placed(known, duration_col, event_col, times), covariate_cols, cuts, ["__risk", "__event"])
    cells = materialize(
        placed.groupBy("codes", "__risk", "__event")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("key", F.xxhash64("codes", "__risk", "__event", F.lit(seed))),
        "cells",
    )
    rows = cells.agg(F.sum("n")).first()[0]
    drawn = cells.repartition("key").mapInArrow(_drawn(len(cuts), n_estimators, min(1.0, max_samples / rows), bootstrap), _DRAWN)
    # a tree is much work on few bytes: many small tasks, so that no core waits for one that was dealt more trees
    grown = drawn.repartition(n_estimators, "tree").groupBy("tree").applyInArrow(_grown(len(cuts), len(times), min_leaf, seed), _TREES)
    return SurvivalForest(materialize(grown, "trees"), tuple(covariate_cols), tuple(cuts), tuple(times.tolist()))

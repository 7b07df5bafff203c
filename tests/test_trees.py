"""Boosting and the survival forest against plain versions that look at rows and values, not at bins and sums."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import binning, boosting, models, survival_forest

ROWS = "id int, a double, b double, c double, d double, e double, event int"


def patients(n=260, seed=4):
    """Five features: an informative one with gaps, one of few values, noise, a constant and one that is never there."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a = draw.choice([None, float("nan"), *[round(draw.uniform(0, 3), 1)] * 5])
        b = float(draw.randint(0, 3))
        chance = 0.2 + (0.5 if a is None or math.isnan(a) else 0.15 * a) * (b > 1)
        rows.append((i, a, b, draw.gauss(0, 1), 1.0, None, draw.choice([None] + [int(draw.random() < chance)] * 19)))
    return rows


def missing(x):
    return x is None or math.isnan(x)


def plain_boosting(rows, rounds, depth, eta):
    """Score of every row, by trying every value of every feature as a cut, missing values on either side."""
    known = [r for r in rows if r[6] is not None]
    y = {r[0]: r[6] for r in known}
    start = 4 * sum(y.values()) / len(y) - 2
    score = {r[0]: start for r in rows}
    for _ in range(rounds):
        p = {i: 1 / (1 + math.exp(-score[i])) for i in y}
        g, h = {i: p[i] - y[i] for i in y}, {i: p[i] * (1 - p[i]) for i in y}

        def grow(inside, all_rows, left):
            total_g, total_h = sum(g[r[0]] for r in inside), sum(h[r[0]] for r in inside)
            best = None
            for f in range(1, 6) if left else ():
                values = sorted({r[f] for r in inside if not missing(r[f])})
                for missing_left in (False, True):
                    for cut in values:
                        low = [r for r in inside if (missing_left if missing(r[f]) else r[f] <= cut)]
                        gl, hl = sum(g[r[0]] for r in low), sum(h[r[0]] for r in low)
                        gr, hr = total_g - gl, total_h - hl
                        if min(hl, hr) < 1:
                            continue
                        gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - total_g**2 / (total_h + 1)
                        if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-9)):
                            best = gain, f, cut, missing_left
            if best is None:
                for r in all_rows:
                    score[r[0]] -= eta * total_g / (total_h + 1)
                return
            _, f, cut, missing_left = best
            side = lambda r: missing_left if missing(r[f]) else r[f] <= cut
            for want in (True, False):
                grow([r for r in inside if side(r) == want], [r for r in all_rows if side(r) == want], left - 1)

        grow(known, rows, depth)
    return {i: 1 / (1 + math.exp(-s)) for i, s in score.items()}


@pytest.mark.parametrize("task_cells,n", [(1 << 16, 260), (0, 260), (1 << 16, 500)])
def test_boosting_against_plain_version(spark, task_cells, n, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_PER_TABLE", 3)
    if n == 260:  # the features two at a time
        monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 4 * 256 * 16 * 2)
    rows = patients(n)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    features, shape = list("abcde"), {"n_estimators": 8, "max_depth": 3, "eta": 0.3}
    model = models.train_boosted_classifier(df, features, params=shape, task_cells=task_cells)
    known = sorted(r[3] for r in rows if r[6] is not None)
    assert len(model.cuts[2]) == min(len(known) - 1, 254) and set(model.cuts[2]) <= set(known)
    assert len(model.cuts[1]) == 3 and len(model.cuts[4]) == 0
    got = {r.id: r.score for r in models.score_classifier(model, df).collect()}
    wanted = plain_boosting(snapped(rows, model.cuts[2]), **{"rounds": 8, "depth": 3, "eta": 0.3})
    assert got == pytest.approx(wanted, abs=1e-9)
    shares = {r.feature: r.importance for r in models.feature_importance(spark, model).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares["d"] == shares["e"] == 0 and min(shares["a"], shares["b"]) > 0


def test_a_level_is_one_stage(spark):
    df = spark.createDataFrame(patients(), ROWS)
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "boosting")
    models.train_boosted_classifier(df, list("abc"), params={"n_estimators": 6, "max_depth": 4}, task_cells=0)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("boosting")]
    assert sum(len(j.stageIds) == 1 for j in jobs) >= 6 * 2 and sum(len(j.stageIds) for j in jobs) < 6 * 4 + 20


def snapped(rows, cuts):
    """The rows with the values of the continuous feature moved up to their cut, as bins see them."""
    points = [*cuts.tolist(), math.inf]
    return [(*r[:3], next(c for c in points if r[3] <= c), *r[4:]) for r in rows]


def test_boosting_learns_and_comes_back(spark, scratch):
    df = spark.createDataFrame(patients(), ROWS)
    model = models.train_boosted_classifier(df, list("abc"), params={"n_estimators": 20})
    model.write(spark, f"{scratch}/model")
    again = boosting.BoostedTrees.read(spark, f"{scratch}/model")
    renamed = df.select("id", *[F.col(c).alias(f"x{c}") for c in "abc"])
    a = {r.id: r.score for r in models.score_classifier(model, df).collect()}
    assert {r.id: r.score for r in models.score_classifier(again, renamed, ["xa", "xb", "xc"]).collect()} == a
    with pytest.raises(ValueError):
        models.train_boosted_classifier(df.withColumn("event", F.lit(None).cast("int")), ["a"])


def test_without_a_split_scores_go_to_the_rate(spark):
    df = spark.createDataFrame([(i, 1.0, int(i % 5 == 0)) for i in range(100)], "id int, x double, event int")
    for task_cells in (0, 10):
        model = models.train_boosted_classifier(df, ["x"], params={"n_estimators": 30, "eta": 0.5}, task_cells=task_cells)
        assert models.score_classifier(model, df).first()["score"] == pytest.approx(0.2, abs=1e-6)
        assert model.importances() == [0.0]


def test_cuts(spark):
    draw = random.Random(1)
    rows = [(float(i % 3), draw.random(), None if i % 2 else float("nan"), 5.0) for i in range(5000)]
    cuts = binning.feature_cuts(spark.createDataFrame(rows, "a double, b double, c double, d double"), list("abcd"))
    assert cuts[0].tolist() == [0.0, 1.0] and not len(cuts[2]) and not len(cuts[3]) and 250 <= len(cuts[1]) <= 254
    ranks = np.searchsorted(sorted(r[1] for r in rows), cuts[1]) / 5000
    assert np.abs(ranks - np.linspace(0, 1, 256)[1:-1][: len(ranks)]).max() < 0.005
    codes = binning.coded([np.array([-1.0, 0.0, 0.5, 1.0, 9.0, np.nan])], [np.array([0.0, 1.0])])
    assert codes.ravel().tolist() == [0, 0, 1, 1, 2, binning.MISSING]


def plain_log_rank(rows, left):
    """|observed - expected| deaths on the left over their standard deviation; rows of (time, event, weight)."""
    excess = variance = 0.0
    for t in sorted({t for t, e, w in rows if e}):
        y = sum(w for u, _, w in rows if u >= t)
        d = sum(w for u, e, w in rows if u == t and e)
        yl = sum(w for (u, _, w), own in zip(rows, left) if own and u >= t)
        excess += sum(w for (u, e, w), own in zip(rows, left) if own and u == t and e) - yl * d / y
        if y > 1:
            variance += d * yl / y * (1 - yl / y) * (y - d) / (y - 1)
    return abs(excess) / math.sqrt(variance) if variance > 1e-12 else 0.0


@pytest.mark.parametrize("seed", range(6))
def test_log_rank_split(seed):
    draw = random.Random(seed)
    n = 60
    codes = np.array([draw.choice([0, 1, 2, 3, 7, binning.MISSING if seed % 2 else 5]) for _ in range(n)], np.uint8)
    times = [draw.randint(1, 12) for _ in range(n)]
    events = [int(draw.random() < 0.6) for _ in range(n)]
    weights = [draw.randint(1, 3) for _ in range(n)]
    grid = sorted({t for t, e in zip(times, events) if e})
    risk = np.array([sum(g <= t for g in grid) for t in times])
    found = survival_forest.log_rank(codes, risk, np.array(events), np.array(weights, float), 10)
    rows, best = list(zip(times, events, weights)), None
    for missing_left in (False, True):
        for cut in sorted(set(codes.tolist()) - {binning.MISSING}):
            left = [missing_left if c == binning.MISSING else c <= cut for c in codes.tolist()]
            size = sum(w for w, own in zip(weights, left) if own)
            if min(size, sum(weights) - size) < 10:
                continue
            value = plain_log_rank(rows, left)
            if value > 0 and (best is None or value > best[0] * (1 + 1e-9)):
                best = value, cut, missing_left
    assert found[0] == pytest.approx(best[0]) and found[1:] == best[1:]


def test_hazards_of_a_leaf():
    times, hazards = survival_forest.nelson_aalen(np.array([1, 2, 2, 3, 3]), np.array([1, 1, 0, 1, 1]), np.array([1.0, 2.0, 1.0, 1.0, 1.0]))
    assert times.tolist() == [1, 2, 3] and hazards.tolist() == pytest.approx([1 / 6, 2 / 5, 1.0])
    assert survival_forest.nelson_aalen(np.array([0, 0]), np.array([0, 0]), np.ones(2))[0].tolist() == []


def test_cuts_that_leave_too_few_are_not_counted():
    risk, event = np.arange(1, 26), np.ones(25, np.int64)
    node = survival_forest._Node(risk, event, np.ones(25))
    counted = []
    node._by_time = lambda group, groups: (counted.append(groups), survival_forest._Node._by_time(node, group, groups))[1]
    found = node.best_cut(np.arange(25).astype(np.uint8), 10)
    # six cuts leave ten on either side: their groups, the rest, and the missing values
    assert counted == [8] and found[1] in range(9, 15)
    assert survival_forest._Node(risk[:19], event[:19], np.ones(19)).best_cut(np.arange(19).astype(np.uint8), 10) is None


def test_hazards_of_all_leaves_at_once():
    draw = np.random.default_rng(3)
    leaf, risk, event = draw.integers(0, 9, 400), draw.integers(0, 30, 400), draw.integers(0, 2, 400)
    event[(leaf == 4) | (risk == 0)] = 0  # a leaf without events
    weight = draw.integers(1, 4, 400).astype(float)
    times, hazards, begins = survival_forest._leaf_hazards(leaf, 9, risk, event, weight)
    for k in range(9):
        wanted = survival_forest.nelson_aalen(risk[leaf == k], event[leaf == k], weight[leaf == k])
        part = slice(begins[k], begins[k + 1])
        assert times[part].tolist() == wanted[0].tolist() and hazards[part].tolist() == wanted[1].tolist()


def test_trees_are_dealt_to_many_tasks(spark):
    df = spark.createDataFrame(survival_rows(), "id int, x double, z double, t double, e int")
    forest = models.train_survival_forest(df, "t", "e", ["x", "z"], n_estimators=40)
    assert len(forest.trees.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions")) + 5


def survival_rows(n=300):
    draw = random.Random(9)
    out = []
    for i in range(n):
        x = draw.random()
        t = draw.expovariate(0.2 + 2 * (x > 0.5))
        out.append((i, None if i % 9 == 0 else x, draw.random(), round(t, 2), int(draw.random() < 0.8)))
    return out + [(n, 0.1, 0.1, None, 1), (n + 1, 0.1, 0.1, 1.0, None)]


def test_forest_does_not_depend_on_the_partitioning(spark):
    df = spark.createDataFrame(survival_rows(), "id int, x double, z double, t double, e int")
    make = lambda d, **more: models.train_survival_forest(d, "t", "e", ["x", "z"], n_estimators=12, **more)
    one, two = make(df.coalesce(1)), make(df.repartition(7, "z"))
    a = {r.id: r.risk for r in one.risk(df).collect()}
    b = {r.id: r.risk for r in two.risk(df, chunk_nodes=40).collect()}
    assert a == pytest.approx(b) and len(a) == 302
    risky = [a[i] for i, x, *_ in survival_rows() if x is not None and x > 0.6]
    safe = [a[i] for i, x, *_ in survival_rows() if x is not None and x < 0.4]
    assert np.mean(risky) > 1.5 * np.mean(safe)
    # a bounded draw takes about so many rows
    small = make(df, max_samples=60).trees.selectExpr("avg(size(left)) as nodes").first()["nodes"]
    assert small < one.trees.selectExpr("avg(size(left)) as nodes").first()["nodes"] / 2


def test_hazard_curves_of_the_leaves(spark):
    df = spark.createDataFrame(survival_rows(), "id int, x double, z double, t double, e int")
    forest = models.train_survival_forest(df, "t", "e", ["x"], n_estimators=3)
    for leaf in forest.leaves().collect():
        curve = [(s["time"], s["cumulative"]) for s in leaf["cumulative_hazard"]]
        assert curve == sorted(curve) and all(t in forest.times for t, _ in curve)
        # the risk is the curve summed over all event times
        at = [max((c for u, c in curve if u <= t), default=0.0) for t in forest.times]
        assert sum(at) == pytest.approx(leaf["risk"])
    with pytest.raises(ValueError):
        models.train_survival_forest(df.withColumn("e", F.lit(0)), "t", "e", ["x"])


def test_many_event_times_become_quantiles(spark):
    df = spark.range(3000).selectExpr("cast(id as double) as t", "1 as e")
    times = survival_forest.event_times(df, "t", "e", max_times=100)
    assert len(times) <= 101 and times[-1] == 2999.0
    assert survival_forest.event_times(df.filter("t < 50"), "t", "e", 100).tolist() == [float(i) for i in range(50)]

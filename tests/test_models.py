"""Metrics against brute force, hazards against a plain numpy fit, forests and boosting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import cox, metrics, models, ordered
from cohortloom.plans import training


def brute_concordance(rows):
    comparable = concordant = 0.0
    for i, (ti, ei, ri) in enumerate(rows):
        for tj, ej, rj in rows[i + 1 :]:
            if ti == tj and ei == ej:
                continue
            first, second = ((ti, ei, ri), (tj, ej, rj))
            if (tj, 1 - ej) < (ti, 1 - ei):
                first, second = second, first
            if first[1] != 1:
                continue
            comparable += 1
            concordant += 1 if first[2] > second[2] else 0.5 if first[2] == second[2] else 0
    return comparable, concordant


@pytest.mark.parametrize("rows_per_bucket", [None, 40])
def test_concordance_matches_all_pairs(spark, monkeypatch, rows_per_bucket):
    if rows_per_bucket:
        monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", rows_per_bucket)
    rng = random.Random(11)
    # a third of the rows share one censoring time
    rows = [(24.0, 0, rng.randrange(9)) if i % 3 == 0 else (float(rng.randrange(60)), rng.randrange(2), rng.randrange(9)) for i in range(240)]
    df = spark.createDataFrame(rows, "t double, e int, r int")
    found = metrics.concordance_index(df, "t", "e", "r").first()
    comparable, concordant = brute_concordance(rows)
    assert (found["comparable"], found["concordant"]) == (comparable, concordant)
    assert found["concordance"] == pytest.approx(concordant / comparable)


def test_concordance_extremes(spark):
    df = spark.createDataFrame([(float(t), 1, float(-t)) for t in range(6)], "t double, e int, r double")
    assert metrics.concordance_index(df, "t", "e", "r").first()["concordance"] == 1.0
    assert metrics.concordance_index(df.withColumn("r", -F.col("r")), "t", "e", "r").first()["concordance"] == 0.0
    assert metrics.concordance_index(df.withColumn("e", F.lit(0)), "t", "e", "r").first()["concordance"] is None


def test_ranking_metrics(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(12) / 10, rng.randrange(2)) for _ in range(150)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum(1 if p > n else 0.5 if p == n else 0 for p in pos for n in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(df, "s", "y").first()[0] == pytest.approx(auc)
    ap, last = 0.0, 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        taken = [y for s, y in rows if s >= cut]
        recall = sum(taken) / len(pos)
        ap, last = ap + (recall - last) * sum(taken) / len(taken), recall
    assert metrics.average_precision(df, "s", "y").first()[0] == pytest.approx(ap)
    assert metrics.roc_auc(df.filter("y = 1"), "s", "y").first()[0] is None


def numpy_cox(t, e, x, penalizer, steps=60):
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    n, p = z.shape
    b = np.zeros(p)
    for _ in range(steps):
        w = np.exp(z @ b)
        grad, hess = np.zeros(p), np.zeros((p, p))
        for time in np.unique(t[e == 1]):
            at, dead = t >= time, (t == time) & (e == 1)
            d = dead.sum()
            grad += z[dead].sum(0)
            for step in range(d):
                v = w * (at - step / d * dead)
                mean = v @ z / v.sum()
                grad -= mean
                hess -= (z * v[:, None]).T @ z / v.sum() - np.outer(mean, mean)
        b = b + np.linalg.solve(penalizer * np.eye(p) - hess / n, grad / n - penalizer * b)
    return b / x.std(0, ddof=1)


@pytest.mark.parametrize("rows_per_bucket", [None, 10])
def test_hazards_match_numpy(spark, monkeypatch, rows_per_bucket):
    if rows_per_bucket:
        monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", rows_per_bucket)
    rng = np.random.default_rng(4)
    n = 180
    x = rng.normal(size=(n, 2)) * [1.0, 3.0] + [5.0, 0.0]
    t = np.ceil(rng.exponential(np.exp(-(0.6 * (x[:, 0] - 5) - 0.2 * x[:, 1]))) * 12)  # many ties
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame(
        [(float(a), int(b), float(c), float(d)) for a, b, (c, d) in zip(t, e, x)], "t double, e int, x double, y double"
    )
    model = cox.train_coxph(df, "t", "e", ["x", "y"], penalizer=0.1)
    assert np.allclose(model.coefficients, numpy_cox(t, e, x, 0.1), atol=1e-6)
    hazards = cox.partial_hazard(model, df).select("x", "y", "partial_hazard").first()
    expected = np.exp((np.array([hazards["x"], hazards["y"]]) - x.mean(0)) @ np.array(model.coefficients))
    assert hazards["partial_hazard"] == pytest.approx(float(expected))


def test_constant_covariate_is_harmless(spark):
    df = spark.createDataFrame([(float(i), i % 2, float(i % 5), 0.0) for i in range(40)], "t double, e int, x double, z double")
    model = cox.train_coxph(df, "t", "e", ["x", "z"])
    assert model.coefficients[1] == 0.0 and model.summary(spark).count() == 2


def separable(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        x = rng.random()
        rows.append((i, x, rng.random(), 1 if x > 0.5 else 0, 100.0 - 90.0 * x + rng.random(), "test" if i % 5 == 0 else "train"))
    return spark.createDataFrame(rows, "id int, x double, noise double, event int, t double, split string")


def test_classification(spark):
    result = training.classification_run(separable(spark), ["x", "noise"], params={"n_estimators": 5})
    scores = {r["metric"]: r["value"] for r in result.metrics.collect()}
    assert scores["test_roc_auc"] > 0.95 and scores["test_pr_auc"] > 0.9
    assert result.importances.first()["feature"] == "x"


def test_survival(spark):
    data = separable(spark).withColumn("event", F.lit(1))
    result = training.survival_run(data, ["x", "noise"], "t", n_estimators=8)
    scores = {r["metric"]: r["value"] for r in result.metrics.collect()}
    assert scores["coxph_test_concordance_index"] > 0.95
    assert scores["survival_forest_test_concordance_index"] > 0.9


def test_training_table(spark):
    df = spark.createDataFrame(
        [("p", "10", "1:DECEASED", None, "3"), ("q", "x", "0:LIVING", 1, "4"), (None, "5", None, 1, "4"), ("r", "5", None, 2, "bad")],
        "patient_key string, OS_MONTHS string, OS_STATUS string, stage_rank int, unmapped string",
    )
    rows = {r["patient_key"]: (r["OS_MONTHS"], r["event"], r["stage_rank"], r["unmapped"]) for r in training.prepare_training_table(df).collect()}
    assert rows == {"p": (10.0, 1, 0.0, 3.0), "r": (5.0, 0, 2.0, 0.0)}
    with pytest.raises(ValueError):
        training.available_features(df.select("patient_key"))


def test_a_hot_time_gives_the_same_fit_in_blocks(spark, monkeypatch):
    from cohortloom.operators import cox

    rows = [(float(i % 3 + 1), int(i % 5 != 0), float((i * 7919) % 101)) for i in range(600)]
    df = spark.createDataFrame(rows, "t double, e int, x double")
    whole = cox.train_coxph(df, "t", "e", ["x"])
    monkeypatch.setattr(cox, "DEATHS_A_BLOCK", 16)
    cut = cox.train_coxph(df, "t", "e", ["x"])
    assert cut.coefficients == pytest.approx(whole.coefficients, rel=1e-9)


def test_survival_models_come_back(spark, scratch):
    from cohortloom.operators import cox, models

    rows = [(float(i % 17 + 1), int(i % 3 == 0), float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "t double, e int, x double")
    fitted = cox.train_coxph(df, "t", "e", ["x"])
    fitted.write(spark, f"{scratch}/cox")
    assert cox.CoxModel.read(spark, f"{scratch}/cox") == fitted
    forest = models.train_survival_forest(df, "t", "e", ["x"], n_estimators=5)
    forest.write(spark, f"{scratch}/forest")
    again = models.SurvivalForest.read(spark, f"{scratch}/forest")
    assert (again.features, again.times) == (forest.features, forest.times)
    assert sorted(map(tuple, again.risk(df).collect())) == sorted(map(tuple, forest.risk(df).collect()))

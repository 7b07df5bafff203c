"""Quantiles, fills, joins, fusion, splits and contracts on small hand-made frames."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.operators import contracts, fuse, genomic, guards, inspect, joins, missing, ordered, outliers
from cohortloom.operators import quantiles, reshape, split


def lower_quantile(values, p):
    ordered_values = sorted(values)
    return ordered_values[max(int(np.ceil(p * len(ordered_values))), 1) - 1]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60))
def test_exact_quantiles(spark, rows):
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    found = {r["g"]: (r["q1"], r["median"], r["q3"]) for r in quantiles.quantiles_grouped(df, "v", ["g"]).collect()}
    for group in {g for g, v in rows if v is not None}:
        mine = [float(v) for g, v in rows if g == group and v is not None]
        assert found[group] == tuple(lower_quantile(mine, p) for p in (0.25, 0.5, 0.75))


def test_exact_quantiles_with_a_coarse_sketch(spark):
    """Narrow slices that must leave most values out, in one hot and one small group."""
    rng = random.Random(3)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(9000)] + [("small", float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    table = quantiles.quantile_table(df, ["v"], [0.1, 0.5, 0.9], ["g"], "exact", accuracy=200).collect()
    for row in table:
        mine = [v for g, v in rows if g == row["g"]]
        assert row[quantiles.quantile_name("v")] == [lower_quantile(mine, p) for p in (0.1, 0.5, 0.9)]


@pytest.mark.parametrize("k, accuracy", [(65_535, 10_000), (8, 10_000), (200, 100)])
def test_exact_quantiles_of_whole_columns(spark, monkeypatch, k, accuracy):
    """Also where the sketch misses, and with nulls, NaN (the greatest of all) and few values."""
    monkeypatch.setattr(quantiles, "KLL_K", k, raising=False)
    rng, nan = random.Random(5), float("nan")
    rows = [
        (rng.gauss(0, 1), float(rng.randrange(7)), nan if i % 3 else float(i), nan, i if i % 5 else None, None)
        for i in range(6000)
    ]
    names = ["many", "few", "odd", "none", "gaps", "empty"]
    df = spark.createDataFrame(rows, "many double, few double, odd double, none double, gaps long, empty double").repartition(5)
    probs = [0.0, 0.1, 0.3333, 0.5, 0.5, 1.0]
    found = quantiles.quantile_table(df, names, probs, (), "exact", accuracy).first()
    for i, name in enumerate(names):
        mine = sorted((r[i] for r in rows if r[i] is not None), key=lambda v: (v != v, v if v == v else 0))
        wanted = [mine[max(int(np.ceil(p * len(mine))), 1) - 1] if mine else None for p in probs]
        assert str(found[quantiles.quantile_name(name)]) == str([None if v is None else float(v) for v in wanted])


def test_whole_columns_are_counted_without_a_row_per_value(spark, monkeypatch):
    """Only rows of a slice become rows per value: neither the sketch nor the counts outside it take them."""
    written = []
    kept = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, label: (written.append((label, df._jdf.queryExecution().optimizedPlan().toString())), kept(df, label))[1])
    df = spark.range(200_000).select((F.col("id") * 7 % 200_003).cast("double").alias("a"), F.col("id").cast("double").alias("b"))
    assert quantiles.global_quantiles(df, ["a", "b"], [0.5])["b"] == [99_999.0]
    plans = dict(written)
    assert "Generate" not in plans["sketch"] and "Join" not in plans["counts"] and "Filter" in plans["counts"]


def test_ordered_vectors_sort_by_a_number_first(spark):
    rows = [(f"p{i % 5}" if i % 9 else None, f"g{i % 3}", None if i % 7 == 0 else float(i), 100 - i) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, gene string, v double, at long")
    made = reshape.long_to_vector(df, "id", "gene", "v", ["g0", "g1", "g2"], order_by=["at"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(id" in plan
    for r in made.collect():
        for k, found in enumerate(r["features"]):
            mine = [(at, v) for i, g, v, at in rows if i == r["id"] and g == f"g{k}" and v is not None]
            assert found == (min(mine)[1] if mine else 0.0)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    for method in ("exact", "approx"):
        assert quantiles.global_quantiles(df, ["v"], [0.25, 0.75], method) == {"v": [None, None]}


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_impute_by_stratum(spark, method):
    rows = [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, None, 5.0), (5, None, None), (6, "c", None)]
    df = spark.createDataFrame(rows, "i int, s string, v double")
    out = {r["i"]: r["v"] for r in missing.impute_numeric_stratified(df, ["v"], ["s"], method).collect()}
    assert out == {1: 1.0, 2: 3.0, 3: 1.0, 4: 5.0, 5: 5.0, 6: None}


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_caps(spark, method):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 7.0), ("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    grouped = outliers.cap_iqr(df, ["v"], ["g"], method=method)
    assert sorted((r["g"], r["v"]) for r in grouped.filter("v is not null").collect()) == [
        ("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 7.0), ("b", 7.0),
    ]
    assert grouped.filter("v is null").count() == 2 and grouped.columns == ["g", "v"]
    whole = outliers.cap_iqr(df, ["v"], method=method)
    assert whole.agg(F.max("v")).first()[0] == 14.5  # q1 = 2, q3 = 7
    empty = outliers.cap_iqr(df.filter("g = 'c'"), ["v"], method=method)
    assert empty.first()["v"] is None


def test_caps_do_not_touch_columns_named_like_fences(spark):
    df = spark.createDataFrame([(1.0, "x", "g"), (2.0, "y", "g")], "v double, q1 string, g string")
    assert outliers.cap_iqr(df, ["v"], ["g"]).columns == ["v", "q1", "g"]


def test_robust_flags(spark):
    df = spark.createDataFrame([(float(v), 1) for v in (1, 2, 3, 4, 1000)] + [(None, 5)], "v double, c int")
    for method in ("exact", "approx"):
        flags = {r["v"]: r["v_is_outlier"] for r in outliers.flag_robust_zscore_outliers(df, ["v", "c"], method=method).collect()}
        assert flags == {1.0: False, 2.0: False, 3.0: False, 4.0: False, 1000.0: True, None: None}
    constant = outliers.flag_robust_zscore_outliers(df, ["c"], method="exact")
    assert {r["c"]: r["c_is_outlier"] for r in constant.collect()} == {1: False, 5: True}


def _fill(rows, method):
    """Brute force over one place, rows sorted by day and tie."""
    out = []
    for i, (day, _, value) in enumerate(rows):
        prev = next(((d, v) for d, _, v in reversed(rows[: i + 1]) if v is not None), None)
        following = next(((d, v) for d, _, v in rows[i:] if v is not None), None)
        if value is None and method == "ffill":
            value = prev and prev[1]
        elif value is None:
            sides = [s for s in (prev, following) if s]
            value = min(sides, key=lambda s: abs((s[0] - day).days))[1] if sides else None
        out.append(value)
    return out


@pytest.mark.parametrize("method", ["ffill", "nearest"])
@pytest.mark.parametrize("rows_per_bucket", [None, 7])
def test_fill_matches_brute_force(spark, method, rows_per_bucket):
    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    places = {"hot": 120, "b": 25, "one": 1, None: 9}
    rows = []
    for place, n in places.items():
        for i in range(n):
            rows.append((place, start + dt.timedelta(days=rng.randrange(60)), i, rng.choice([None, None, rng.random()])))
    df = spark.createDataFrame(rows, "p string, d date, i int, v double").repartition(5)
    out = missing.fill_environmental_nearest(df, "v", "p", "d", ["i"], method, rows_per_bucket)
    found = {(r["p"], r["i"]): r["v"] for r in out.collect()}
    assert len(found) == len(rows)
    for place in places:
        mine = sorted(((d, i, v) for p, d, i, v in rows if p == place), key=lambda r: r[:2])
        assert [found[(place, i)] for _, i, _ in mine] == _fill(mine, method)


def test_running_sums_over_many_buckets(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.randrange(20), i, rng.randrange(5)) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, k int, i int, v long").repartition(4)
    out = ordered.running_sums(df, ["k", "i"], ["v"], ["g"], rows_per_bucket=40)
    found = {r["i"]: r["cum_v"] for r in out.collect()}
    totals = {}
    for g, k, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        totals[g] = totals.get(g, 0) + v
        assert found[i] == totals[g]


def test_order_windows_are_never_global(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 7)
    plan = ordered.ordered_prefix_sum(df, ["id"], "v", rows_per_bucket=500)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_pivot_takes_first_value(spark):
    rows = [("p", "s", "AGE", None, 1), ("p", "s", "AGE", "7", 2), ("p", "s", "AGE", "8", 3), ("p", "t", "SEX", "F", 1)]
    df = spark.createDataFrame(rows, "p string, s string, a string, v string, n int")
    wide = reshape.pivot_long_to_wide(df, ["p", "s"], "a", "v", order_by=["n"])
    assert {(r["s"], r["AGE"], r["SEX"]) for r in wide.collect()} == {("s", "7", None), ("t", None, "F")}


def test_vectors_from_a_long_table(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "y", 3.0), ("b", "z", 9.0)], "id string, g string, v double")
    out = reshape.long_to_vector(df, "id", "g", "v", ["x", "y"])
    assert {r["id"]: list(r["features"].toArray()) for r in out.collect()} == {"a": [1.0, 2.0], "b": [0.0, 3.0]}


def test_fusion(spark):
    a = spark.createDataFrame([("p", 1, 5), ("q", None, None), (None, 9, 9)], "k string, x int, y int")
    b = spark.createDataFrame([("p", 2), ("r", 3)], "k string, x int")
    out = fuse.fuse_modalities({"a": a, "b": b}, "k")
    assert out.columns == ["k", "a_x", "y", "b_x", "has_a_data", "has_b_data"]
    rows = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert rows == {
        "p": (1, 5, 2, True, True),
        "q": (None, None, None, False, False),
        "r": (None, None, 3, False, True),
        None: (9, 9, None, True, False),
    }


def test_fusion_refuses_repeated_ids(spark):
    a = spark.createDataFrame([("p", 1), ("p", 2)], "k string, x int")
    b = spark.createDataFrame([("p", 5), ("q", 6)], "k string, z int")
    with pytest.raises(ValueError, match="several rows"):
        fuse.fuse_modalities({"a": a, "b": b}, "k")
    out = fuse.fuse_modalities({"b": b, "a": a}, "k", repeated="a")
    assert sorted((r["k"], r["x"], r["z"]) for r in out.filter("x is not null").collect()) == [("p", 1, 5), ("p", 2, 5)]
    assert out.count() == 3
    with pytest.raises(ValueError, match="no column"):
        fuse.fuse_modalities({"a": a.select("k")}, "k")


def test_burden_rows_add_up(spark):
    calls = spark.createDataFrame([("p", "TP53"), ("p", "TP53"), ("p", "TTN"), ("q", "KRAS"), ("q", None)], "patient_key string, gene string")
    paths = spark.createDataFrame([("TP53", "p53"), ("KRAS", "ras")], "gene string, pathway string")
    out = {r["patient_key"]: r.asDict() for r in genomic.aggregate_mutation_burden(calls, paths).collect()}
    assert out["p"] == {"patient_key": "p", "p53": 2, "ras": 0, "unmapped": 1}
    assert out["q"] == {"patient_key": "q", "p53": 0, "ras": 1, "unmapped": 1}


def test_top_variable_genes(spark):
    rows = [("flat", 1.0), ("flat", 1.0), ("wild", 0.0), ("wild", 9.0), ("once", 5.0), (None, 7.0), ("bad", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert [r["g"] for r in genomic.top_k_by_variance(df, "g", "v", 3).collect()] == ["wild", "flat", "bad"]
    assert genomic.top_variable_genes(df, "g", "v", 1).count() == 2


def test_components_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(40, 6)) * np.array([1, 2, 3, 4, 5, 6])
    genes = [f"g{i}" for i in range(6)]
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(data)], "patient_key int, " + ", ".join(f"{g} double" for g in genes))
    out = genomic.reduce_expression_pca(df, genes, 3).orderBy("patient_key").toPandas()
    z = (data - data.mean(0)) / data.std(0, ddof=1)
    _, _, axes = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(np.abs(out[[f"expression_pca_{i}" for i in range(3)]].to_numpy()), np.abs(z @ axes[:3].T), atol=1e-6)
    assert genomic.pca_rank(2000, 8) == 7 and genomic.pca_rank(3, 1) == 1


@pytest.mark.parametrize("parts", [1, 6])
def test_split_by_patient(spark, parts):
    rows = [(i % 400, "a" if i % 400 < 300 else "b") for i in range(900)] + [(None, "a")]
    df = spark.createDataFrame(rows, "p int, s string").repartition(parts)
    train, test = split.patient_level_split(df, "p", "s")
    left, right = ({r["p"] for r in side.collect()} for side in (train, test))
    assert not left & right and len(left | right) == 400
    assert len([p for p in right if p < 300]) == 60 and len([p for p in right if p >= 300]) == 20
    assert train.count() + test.count() == 900
    import hashlib

    ranked = sorted(range(300), key=lambda p: hashlib.md5(f"{p}|42".encode()).hexdigest())
    assert {p for p in right if p < 300} == set(ranked[:60])


def test_split_of_a_tiny_stratum(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "a")], "p int, s string")
    out = {r["p"]: r["split"] for r in split.assign_split(df, "p", "s").collect()}
    assert out == {1: "train", 2: "train"}  # 2 is in stratum a, whose share rounds to none


def test_contract_reports_everything(spark):
    df = spark.createDataFrame([(None, "1", -1.0), ("06", "2", None)], "state_code string, county_code string, arithmetic_mean double")
    report = {(r["column"], r["check"]): r["failures"] for r in contracts.validate(df, contracts.PM25, False).collect()}
    assert report[("date_local", "exists")] == 1 and ("date_local", "not_null") not in report
    assert report[("state_code", "not_null")] == 1 and report[("arithmetic_mean", "ge")] == 1
    with pytest.raises(contracts.ContractViolation) as caught:
        contracts.validate(df, contracts.PM25)
    assert {(c, k) for c, k, _ in caught.value.failures} == {("date_local", "exists"), ("state_code", "not_null"), ("arithmetic_mean", "ge")}
    good, bad = contracts.quarantine(df, contracts.PM25)
    assert good.count() == 1 and bad.count() == 1


def test_guards(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "f string")
    assert guards.guard_min_groups(df, "f", 2) is df
    with pytest.raises(ValueError):
        guards.guard_min_groups(df, "f", 3)
    with pytest.raises(ValueError):
        guards.guard_not_empty(df.limit(0))
    with pytest.raises(ValueError):
        guards.guard_min_columns(["a"], 2)


def test_overlap_and_profile(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    counts = {r["measure"]: r["n"] for r in joins.key_overlap({"a": a, "b": b}, "k").collect()}
    assert counts == {"rows:a": 3, "rows:b": 2, "keys:a": 2, "keys:b": 2, "overlap:a&b": 1}
    profile = inspect.table_profile(a.union(spark.createDataFrame([(None,)], "k string"))).first()
    assert tuple(profile) == ("k", "string", 4, 1, 2)
    assert inspect.distinct_count(a, ["k"], approximate=True).first()["distinct_values"] == 2


def test_unions(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert reshape.concat_frames([a, b]).count() == 2
    with pytest.raises(Exception):
        reshape.union_by_name([(a, "a"), (b, "b")]).count()

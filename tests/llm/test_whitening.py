import math

import numpy as np
import pytest

from cohortloom.llm import whitening
from cohortloom.llm.bidiagonal import right_singular
from cohortloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(vectors, k=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype(np.float64)
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    return deviation, centred @ directions / np.sqrt(values), values / np.trace(covariance)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = QUERIES["op11_whitening"](spark, SMALL)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    kept = [r for r in rows if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    deviation, white, explained = brute([r["embedding"] for r in kept])
    by_id = {r["vec_id"]: i for i, r in enumerate(kept)}
    found = got.collect()
    assert len(found) == 32 * len(kept) and {r["n"] for r in found} == {len(kept)}
    ours = np.zeros_like(white)
    for r in found:
        i, c = by_id[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[i]
        assert abs(r["explained"] / explained[c] - 1) < 1e-10
        ours[i, c] = r["whitened"]
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    signs = np.sign((ours * white).sum(axis=0))
    assert np.abs(ours - white * signs).max() < 1e-7
    assert abs(np.abs(np.cov(ours.T, bias=True) - np.eye(32)).max() - found[0]["identity_error"]) < 1e-10


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0, -2.0], "x"), (2, [1.5, 0.25, 0.0], "x"), (2, [1.5, 0.25, 0.0], None), (None, [-1.0, 3.0, 0.5], "x"),
        (3, None, "x"), (4, [], "x"), (5, [1.0, None, 2.0], "x"), (6, [nan, 0.0, 1.0], "x"), (7, [inf, 0.0, 1.0], "x"),
        (8, [1.0, 2.0], "x"), (9, [7.0, -3.0, 2.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").repartition(5)
    found = whitening.whiten(df, block_rows=2).collect()
    kept = [r for r in rows if r[0] in (1, 2, None, 9)]
    assert sorted(str(r.vec_id) for r in found) == sorted(str(r[0]) for r in kept for _ in range(3))
    deviation, white, _ = brute([r[1] for r in kept], 3)
    assert sorted(int(r.deviation) for r in found if r.component == 1) == sorted(deviation)
    for c in range(3):
        ours = sorted(abs(r.whitened) for r in found if r.component == c + 1)
        assert np.allclose(ours, sorted(np.abs(white[:, c])), atol=1e-9)
    assert whitening.whiten(df.filter("false")).collect() == []
    assert whitening.whiten(df.filter("vec_id in (3, 4, 5, 6, 7)")).collect() == []
    # one row has no variance at all, two have one component
    one = whitening.whiten(df.filter("vec_id = 1")).collect()
    assert [r.whitened for r in one] == [None] * 3 and {r.explained for r in one} == {None} and one[0].identity_error is None
    two = whitening.whiten(df.filter("vec_id in (1, 9)")).collect()
    assert sum(r.whitened is not None for r in two) == 2 and two[0].identity_error < 1e-12


def test_large_entries_stay_exact(spark):
    """Entries whose squares no 64-bit sum holds, and counts of many parts."""
    draw = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in draw.normal(1e9, 1e9, 4)]) for i in range(40)] + [(99, [1e300, -1e300, 0.0, 5.0])]
    df = spark.createDataFrame(vectors[:-1], "vec_id long, embedding array<double>").repartition(40)
    found = whitening.whiten(df, block_rows=3).filter("component = 1").collect()
    deviation, _, _ = brute([v for _, v in vectors[:-1]], 4)
    assert {r.vec_id: int(r.deviation) for r in found} == {i: deviation[i] for i in range(40)}
    far = spark.createDataFrame(vectors[-1:], "vec_id long, embedding array<double>")
    assert whitening.whiten(far).count() == 4


@pytest.mark.parametrize("case", ["random", "graded", "equal", "close", "rank", "split"])
def test_solver(case):
    draw = np.random.default_rng(1)
    n = 40
    basis = np.linalg.qr(draw.standard_normal((n, n)))[0]
    values = {
        "random": draw.uniform(0.1, 3, n), "graded": 10.0 ** -np.arange(n / 5, step=0.2), "equal": np.repeat([3.0, 2.0, 1.0, 0.5], 10),
        "close": 2 + 1e-10 * np.arange(n), "rank": np.r_[np.ones(5), np.zeros(n - 5)], "split": np.arange(1.0, n + 1),
    }[case]
    matrix = np.diag(values) if case == "split" else basis @ np.diag(values) @ basis.T
    wanted = np.sort(values)[::-1] ** 2
    got, vectors = right_singular(matrix, 32)
    assert np.abs(got - wanted[:32]).max() <= 1e-12 * wanted[0]
    real = got > 1e-20 * wanted[0]
    v = vectors[real]
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-9
    assert np.abs(matrix.T @ (matrix @ v.T) - v.T * got[real]).max() < 1e-9 * wanted[0]

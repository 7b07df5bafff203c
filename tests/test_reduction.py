"""Components of long vectors against numpy, with more columns than a dense matrix of them could have."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortloom.operators import genomic, reduction


def frame(spark, data, parts=4):
    rows = [(i, row.tolist()) for i, row in enumerate(data)]
    df = spark.createDataFrame(rows, "patient_key int, x array<double>").repartition(parts)
    return df.select("patient_key", array_to_vector("x").alias("v"))


def standardised(data):
    std = data.std(0, ddof=1)
    return (data - data.mean(0)) * np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)


@pytest.mark.parametrize("n,d,k", [(300, 120, 50), (9, 200, 8), (40, 3, 3), (500, 64, 64)])
def test_axes_and_variances(spark, n, d, k):
    rng = np.random.default_rng(n)
    data = rng.normal(size=(n, d)) @ np.diag(0.9 ** np.arange(d)) @ rng.normal(size=(d, d)) + 100
    data[:, d // 2] = 7.0  # a column that never varies
    z = standardised(data)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    found = reduction.standard_axes(frame(spark, data), "v", k)
    assert np.allclose(found.variances, s[:k] ** 2 / (n - 1), rtol=1e-8, atol=1e-8)
    assert np.allclose(found.axes.T @ found.axes, np.eye(k), atol=1e-9)
    real = s[:k] > 1e-6 * s[0]
    assert np.abs(np.abs(np.sum(found.axes.T * vt[:k], axis=1)) - 1)[real].max() < 1e-6
    largest = np.abs(found.axes).argmax(axis=0)
    assert (found.axes[largest, np.arange(k)] > 0).all()
    rows = genomic.reduce_vector_pca(frame(spark, data), "v", k).orderBy("patient_key").toPandas()
    assert np.allclose(rows.drop(columns="patient_key").to_numpy(), z @ found.axes, atol=1e-8)


def test_more_columns_than_a_dense_matrix_may_have(spark):
    rng = np.random.default_rng(5)
    n, d, k = 30, 66_000, 5
    data = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) * 3 + rng.normal(size=(n, d))
    _, s, vt = np.linalg.svd(standardised(data), full_matrices=False)
    found = reduction.standard_axes(frame(spark, data), "v", k)
    assert np.allclose(found.variances, s[:k] ** 2 / (n - 1), rtol=1e-10)
    assert np.abs(np.abs(np.sum(found.axes.T[:3] * vt[:3], axis=1)) - 1).max() < 1e-9


def test_many_parts_merge_in_a_tree(spark):
    data = np.random.default_rng(2).normal(size=(400, 6))
    one = reduction.standard_axes(frame(spark, data, 1), "v", 4)
    many = reduction.standard_axes(frame(spark, data, 40), "v", 4)
    assert np.allclose(one.variances, many.variances, rtol=1e-12) and np.allclose(one.axes, many.axes, atol=1e-9)
    with pytest.raises(ValueError):
        reduction.standard_axes(frame(spark, data).filter(F.lit(False)), "v", 2)

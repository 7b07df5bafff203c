"""Every registered query against its SQL; the ones without SQL must give rows."""

import os
import subprocess
import sys

import pytest

import __spark_entry__
from suite.registry import ORACLES, QUERIES
from tests.oracle import connect, differences

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# the smallest data makes a single count file, fewer than expression data needs
NEEDS_FILES = {"guard_min_groups", "ingest_rna_seq", "patient_features_tcga"}
NO_SQL = sorted(set(QUERIES) - set(ORACLES))
# 300 trees, whatever the size of the data
LEARNING = {"survival_forest_features", "survival_run_features"}


@pytest.fixture(scope="module")
def databases():
    return {path: connect(path) for path in (SMALL, LARGER)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, databases, name):
    sf_dir = LARGER if name in NEEDS_FILES else SMALL
    found = QUERIES[name](spark, sf_dir).toPandas()
    wanted = databases[sf_dir].execute(ORACLES[name]).df()
    assert differences(found, wanted) is None


@pytest.mark.parametrize("name", NO_SQL)
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL if name in LEARNING else LARGER).count() > 0


def test_all_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1500


def test_without_the_packages_of_the_training_data_part():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert [int(n) for n in done.stdout.split()] == [len(QUERIES), len(ORACLES)]

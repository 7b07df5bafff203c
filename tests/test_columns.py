"""Casts, flags, de-identification and encoders on their edge cases."""

import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom import defaults
from cohortloom.functions import columns, deident, encode
from cohortloom.operators import linkage


def values(df, column):
    return [r[column] for r in df.collect()]


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("x",), (None,), ("1e3",)], "a string")
    assert values(columns.cast_columns(df, {"a": "double"}), "a") == [12.0, 12.0, None, None, 1000.0]
    assert values(columns.cast_columns(df, {"a": "int"}), "a")[:4] == [12, 12, None, None]


def test_indicator_survives_a_fill(spark):
    df = spark.createDataFrame([(None,), ("x",)], "a string")
    out = columns.fill_categorical_unknown(columns.add_missing_indicators(df, ["a"]), ["a"])
    assert [tuple(r) for r in out.collect()] == [("Unknown", True), ("x", False)]


def test_absent_call_is_not_tested(spark):
    df = spark.createDataFrame([(None,), ("wild_type",)], "s string")
    assert values(columns.flag_genomic_not_tested(df, "s"), "s") == ["not_tested", "wild_type"]


def test_fill_zero_leaves_text(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    assert tuple(columns.fill_zero(df, ["a"]).first()) == (0.0, None)


def test_event_of_status(spark):
    df = spark.createDataFrame([("1:DECEASED",), ("0:LIVING",), (None,), ("10",)], "s string")
    assert values(columns.derive_event(df, "s"), "event") == [1, 0, 0, 1]


def test_sanitized_names_stay_unique():
    assert columns.sanitized_names(["k-k", "HLA-A", "HLA.A", "HLA_A"], keep=["k-k"]) == ["k-k", "HLA_A", "HLA_A_2", "HLA_A_3"]


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x", True)], "a int, b long, c double, d string, e boolean")
    assert columns.numeric_columns(df) == ["a", "b", "c"]


def test_identifiers_are_dropped_if_there(spark):
    df = spark.createDataFrame([("x", "y", 1)], "ssn string, sampleId string, keep int")
    assert deident.drop_direct_identifiers(df, ["sampleId"]).columns == ["keep"]
    assert len(defaults.DIRECT_IDENTIFIERS) == 15


def test_key_is_a_salted_hash(spark):
    df = spark.createDataFrame([("p1",), (None,)], "id string")
    keys = values(deident.pseudonymize_patient_id(df, "id", "salt"), "patient_key")
    assert keys == [hashlib.sha256(b"p1salt").hexdigest(), None]
    assert deident.pseudonymize_patient_id(df, "id", "salt", "id").columns == ["id"]


@settings(max_examples=15, deadline=None)
@given(keys=st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=20), gap=st.integers(0, 4000))
def test_shift_keeps_intervals(spark, keys, gap):
    first = dt.date(2001, 3, 4)
    df = spark.createDataFrame([(k, first, first + dt.timedelta(days=gap)) for k in keys], "k string, a date, b date")
    moved = deident.shift_dates(df, ["a", "b"], "k").collect()
    assert all((r["b"] - r["a"]).days == gap for r in moved)
    assert all(-365 <= (r["a"] - first).days <= 364 for r in moved)
    by_key = {}
    for r in moved:
        assert by_key.setdefault(r["k"], r["a"]) == r["a"]


def test_shift_of_a_null_key(spark):
    df = spark.createDataFrame([(None, dt.date(2020, 1, 1))], "k string, a date")
    assert deident.shift_dates(df, ["a"], "k").first()["a"] == dt.date(2020, 1, 1) - dt.timedelta(days=323)


def test_zip_areas(spark):
    df = spark.createDataFrame([("03601",), ("02139",), (None,)], "z string")
    assert values(deident.generalize_zip_to_safe_harbor(df, "z"), "z") == ["000", "021", None]
    out = deident.generalize_zip_to_safe_harbor(df, "z", ["021"], "zip3")
    assert values(out, "zip3") == ["036", "000", None] and values(out, "z")[0] == "03601"


def test_old_ages(spark):
    df = spark.createDataFrame([(89.0,), (89.5,), (120.0,), (None,), (float("nan"),)], "a double")
    assert values(deident.truncate_age_over_90(df, "a"), "a") == [89.0, 90.0, 90.0, None, None]
    ints = spark.createDataFrame([(95,)], "a int")
    assert deident.truncate_age_over_90(ints, "a").schema["a"].dataType.simpleString() == "int"


@pytest.mark.parametrize("text, rank", [
    ("STAGE IIIA", 8), (" stage iib ", 6), ("IV", 11), ("Stage 0", 0), ("STAGE X", None), ("STAGEIV", None), (None, None),
])
def test_stage_rank(spark, text, rank):
    df = spark.createDataFrame([(text,)], "s string")
    assert encode.encode_tnm_stage_ordinal(df, "s", "r").first()["r"] == rank


def test_categories(spark):
    df = spark.createDataFrame([("C50.911",), ("C50.1",), ("C34",), (None,)], "icd string")
    rows = encode.encode_icd10_category(df, "icd").collect()
    assert [r["icd_category"] for r in rows] == ["C50", "C50", "C34", None]
    assert [r["icd_category_idx"] for r in rows] == [0.0, 0.0, 1.0, 2.0]
    assert [list(r["icd_category_vec"].toArray()) for r in rows] == [[1, 0], [1, 0], [0, 1], [0, 0]]


def test_days_between(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2019, 12, 31)), (None, dt.date(2020, 1, 1))], "t date, i date")
    assert values(encode.encode_days_since_treatment(df, "t", "i", "d"), "d") == [-1, None]


def test_blocking_key_policies(spark):
    df = spark.createDataFrame([("F", 1950, "02139"), (None, 1950, "02139")], "s string, y int, z string")
    assert values(linkage.build_blocking_key(df, "s", "y", "z"), "_blocking_key") == ["F|1950|021", "1950|021"]
    strict = linkage.build_blocking_key(df, "s", "y", "z", null_policy="null")
    assert values(strict, "_blocking_key") == ["F|1950|021", None]
    more = linkage.build_blocking_key(df, "s", "y", "z", extra_cols=["z"])
    assert values(more, "_blocking_key")[0] == "F|1950|021|02139"


def test_master_ids_link_and_repeat(spark):
    a = spark.createDataFrame([("a1", "k"), ("a1", "k"), ("a2", None)], "_source_patient_id string, _blocking_key string")
    b = spark.createDataFrame([("b1", "k")], "_source_patient_id string, _blocking_key string")
    ids = linkage.assign_master_patient_id((a, "a"), (b, "b"), salt="s")
    assert ids.columns == ["_source_name", "_source_patient_id", "master_patient_id", "_blocking_key"]
    by_source = {r["_source_patient_id"]: r["master_patient_id"] for r in ids.collect()}
    assert by_source["a1"] == by_source["b1"] and by_source["a2"] is None
    again = linkage.assign_master_patient_id((b.repartition(3), "b"), (a, "a"), salt="s", dedupe=True).collect()
    assert len(again) == 3 and {r["master_patient_id"] for r in again} == set(by_source.values())

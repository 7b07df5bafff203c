"""Bronze to silver: reshape, repair and de-identify each domain.

The ``*_frame`` functions go from frame to frame; the others read and write a lake.
A step whose input table is absent returns None.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.functions.columns import cast_columns, fill_categorical_unknown, flag_genomic_not_tested, numeric_columns
from cohortloom.functions.deident import (
    drop_direct_identifiers,
    generalize_zip_to_safe_harbor,
    pseudonymize_patient_id,
    shift_dates,
    truncate_age_over_90,
)
from cohortloom.operators.missing import fill_environmental_nearest, impute_numeric_stratified
from cohortloom.operators.outliers import cap_iqr, flag_robust_zscore_outliers
from cohortloom.operators.reshape import pivot_long_to_wide
from cohortloom.runtime import attach, cleans_up, materialize, present
from cohortloom.sources.layers import SLICE, layer_path, overwrite_table, scan_layer, table_exists

CLINICAL_NUMERIC = ("AGE", "MUTATION_COUNT")
CLINICAL_CATEGORICAL = ("SEX", "CANCER_TYPE", "AJCC_PATHOLOGIC_TUMOR_STAGE")
STRATUM = "CANCER_TYPE"


def clean_clinical_frame(
    raw: DataFrame,
    salt: str,
    attributes: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    method: str = "approx",
    extra_identifiers: Sequence[str] = (),
) -> DataFrame:
    """Long clinical attributes to one clean row per sample.

    ``attributes`` names the wide columns in advance. The wide table is written once,
    because medians and fences are each taken from it.
    """
    wide = pivot_long_to_wide(raw, ["patientId", "sampleId"], "clinicalAttributeId", "value", attributes, order_by)
    numeric = present(wide, CLINICAL_NUMERIC)
    wide = materialize(cast_columns(wide, dict.fromkeys(numeric, "double")), "wide")
    strata = present(wide, [STRATUM])
    if numeric:
        if strata:
            wide = impute_numeric_stratified(wide, numeric, strata, method)
        wide = cap_iqr(wide, numeric, strata, method=method)
    wide = fill_categorical_unknown(wide, present(wide, CLINICAL_CATEGORICAL))
    if "AGE" in wide.columns:
        wide = truncate_age_over_90(wide, "AGE")
    return drop_direct_identifiers(pseudonymize_patient_id(wide, "patientId", salt), extra_identifiers)


def clean_mutations_frame(raw: DataFrame, salt: str, extra_identifiers: Sequence[str] = ()) -> DataFrame:
    for status in present(raw, ["mutationType"]):
        raw = flag_genomic_not_tested(raw, status)
    return pseudonymize_patient_id(raw, "patientId", salt).drop(*extra_identifiers)


def clean_rna_seq_frame(
    raw: DataFrame,
    salt: str,
    group_cols: Sequence[str] = (),
    method: str = "approx",
    extra_identifiers: Sequence[str] = (),
) -> DataFrame:
    numeric = numeric_columns(raw)
    if numeric:
        raw = flag_robust_zscore_outliers(raw, numeric, group_cols=group_cols, method=method)
    return pseudonymize_patient_id(raw, "submitter_id", salt).drop(*extra_identifiers)


def clean_environmental_frame(
    raw: DataFrame,
    place_cols: Sequence[str] = ("county_code",),
    tie_cols: Sequence[str] = (),
    fill: str = "ffill",
) -> DataFrame:
    readings = cast_columns(raw, {"arithmetic_mean": "double"})
    return fill_environmental_nearest(readings, "arithmetic_mean", place_cols, "date_local", tie_cols, fill)


def clean_seer_frame(
    raw: DataFrame,
    salt: str,
    restricted_zip3: Sequence[str] = tuple(defaults.RESTRICTED_ZIP3),
    extra_identifiers: Sequence[str] = (),
) -> DataFrame:
    df = truncate_age_over_90(cast_columns(raw, {"age_at_diagnosis": "int"}), "age_at_diagnosis")
    df = pseudonymize_patient_id(df, "patient_id_number", salt)
    if "zip_code" in df.columns:
        df = generalize_zip_to_safe_harbor(df, "zip_code", restricted_zip3)
    dates = present(df, ["diagnosis_date", "last_contact_date"])
    if dates:
        df = shift_dates(df, dates, "patient_key")
    return df.drop(*extra_identifiers)


def _bronze(spark: SparkSession, root: str, domain: str, slices: str) -> DataFrame | None:
    path = layer_path(root, "bronze", domain)
    return scan_layer(spark, path, slices=slices) if table_exists(spark, path) else None


@cleans_up
def clean_clinical(spark: SparkSession, root: str, salt: str, slices: str = "latest", **options) -> str | None:
    raw = _bronze(spark, root, "cbioportal_clinical", slices)
    if raw is None:
        return None
    return overwrite_table(clean_clinical_frame(raw, salt, **options), layer_path(root, "silver", "clinical"))


@cleans_up
def clean_mutations(spark: SparkSession, root: str, salt: str, slices: str = "latest", **options) -> str | None:
    raw = _bronze(spark, root, "cbioportal_mutations", slices)
    if raw is None:
        return None
    return overwrite_table(clean_mutations_frame(raw, salt, **options), layer_path(root, "silver", "mutations"))


@cleans_up
def clean_rna_seq(spark: SparkSession, root: str, salt: str, slices: str = "latest", **options) -> str | None:
    raw = _bronze(spark, root, "gdc_rna_seq_counts", slices)
    if raw is None:
        return None
    return overwrite_table(clean_rna_seq_frame(raw, salt, **options), layer_path(root, "silver", "rna_seq"))


READING_KEY = ("state_code", "county_code", "site_number", "site_num", "parameter_code", "poc", "sample_duration", "date_local")


def newest_readings(raw: DataFrame, key: Sequence[str] = READING_KEY) -> DataFrame:
    """Of the slices that hold a key, the rows of the newest one.

    Slices look back and so overlap. The key is what the table has of the columns given; all rows that a slice has for
    one key stay.
    """
    keys = present(raw, key)
    newest = materialize(raw.groupBy(*keys).agg(F.max(SLICE).alias("__newest")), "newest")
    return attach(raw, newest, keys).filter(F.col(SLICE) == F.col("__newest")).drop("__newest")


@cleans_up
def clean_environmental(spark: SparkSession, root: str, slices: str = "all", **options) -> str | None:
    """The readings of all slices, each as its newest slice has it."""
    raw = _bronze(spark, root, "environmental_pm25", slices)
    if raw is None:
        return None
    if slices == "all" and SLICE in raw.columns:
        raw = newest_readings(raw)
    clean = clean_environmental_frame(raw, **options)
    return overwrite_table(clean, layer_path(root, "silver", "environmental_pm25"))


@cleans_up
def clean_seer(spark: SparkSession, root: str, salt: str, slices: str = "latest", **options) -> str | None:
    raw = _bronze(spark, root, "seer_extract", slices)
    if raw is None:
        return None
    return overwrite_table(clean_seer_frame(raw, salt, **options), layer_path(root, "silver", "seer_extract"))

"""Landed source files to bronze slices. Each function validates before it writes
and returns the path of the bronze table."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.operators import contracts
from cohortloom.operators.guards import guard_min_groups, guard_not_empty
from cohortloom.runtime import cleans_up, folder_entries, materialize
from cohortloom.sources import delimited, records
from cohortloom.sources.layers import layer_path, write_bronze_slice

PM25_RECORD = "state_code string, county_code string, date_local string, arithmetic_mean string"
FILE_HIT = (
    "file_id string, file_name string, data_type string, data_format string, data_category string, "
    "project_id string, access string, cases array<struct<case_id: string, submitter_id: string>>"
)


@cleans_up
def ingest_cbioportal_clinical(
    spark: SparkSession, root: str, sample_path: str, patient_path: str | None,
    ingestion_date: str | None = None, multi_line: bool = True,
) -> str:
    df = records.scan_eav_clinical(spark, sample_path, patient_path, multi_line)
    return _published(df, layer_path(root, "bronze", "cbioportal_clinical"), ingestion_date, contracts.CLINICAL)


@cleans_up
def ingest_cbioportal_mutations(
    spark: SparkSession, root: str, path: str, ingestion_date: str | None = None, multi_line: bool = True
) -> str:
    """All columns of the records are kept."""
    df = records.scan_mutation_records(spark, path, multi_line=multi_line)
    return _published(df, layer_path(root, "bronze", "cbioportal_mutations"), ingestion_date, contracts.MUTATIONS)


def list_files(
    hits: DataFrame, project_id: str, category: str, data_format: str | None, limit: int | None = None
) -> DataFrame:
    """Chosen files of a landed listing, one row per file and case."""
    chosen = delimited.file_metadata_filter(hits, project_id, category, data_format, size=limit)
    guard_not_empty(chosen, f"the {category} listing of {project_id}")
    return records.json_explode_nested(
        chosen, "cases", ["file_id", "file_name", "data_type", "data_format"], prefix="cases."
    )


@cleans_up
def ingest_gdc_metadata(
    root: str, hits: DataFrame, project_id: str, category: str, data_format: str | None,
    ingestion_date: str | None = None, limit: int | None = None,
) -> str:
    return _published(
        list_files(hits, project_id, category, data_format, limit),
        layer_path(root, "bronze", "gdc_mutation_file_metadata"),
        ingestion_date,
        contracts.FILE_METADATA,
    )


def _published(
    df: DataFrame, path: str, ingestion_date: str | None, contract: contracts.Contract | None = None
) -> str:
    """Write a source once to the shared folder, checking it on the way, and publish it as a slice.

    The raw files are read once however many checks there are; a failed check leaves the slice as it was.
    """
    watch = None if contract is None else contracts.Watch(df, contract)
    staged = materialize(df if watch is None else watch.df, "staged")
    if watch is not None:
        watch.validate()
    return write_bronze_slice(staged, path, ingestion_date)


def _listed_files(spark: SparkSession, files: DataFrame, limit: int | None, folder: str, naming: str) -> tuple[DataFrame, list[str]]:
    """The listing, cut to ``limit`` entries if given, and the paths of its files that have landed.

    Listed files that are absent are reported and left out. The driver knows the names in the folder, as it does for
    any folder that Spark reads, and learns no more ids than that.
    """
    listing = files.withColumnsRenamed({"cases.case_id": "case_id", "cases.submitter_id": "submitter_id"})
    listing = materialize(listing if limit is None else delimited.limit_files(listing, limit), "listing")
    names = [(n,) for n in sorted(folder_entries(spark, folder))]
    landed = spark.createDataFrame(names, "__name string")
    before, after = naming.split("{file_id}")
    wanted = listing.select("file_id", F.concat(F.lit(before), "file_id", F.lit(after)).alias("__name")).distinct()
    absent = wanted.join(landed, "__name", "left_anti").count()
    if absent:
        warnings.warn(f"{absent} listed files are not in {folder}", stacklevel=3)
    there = [r["__name"] for r in wanted.join(landed, "__name", "left_semi").select("__name").collect()]
    return listing, [f"{folder.rstrip('/')}/{n}" for n in sorted(there)]


@cleans_up
def ingest_rna_seq(
    spark: SparkSession, root: str, files: DataFrame, folder: str,
    limit: int | None = None, minimum: int = defaults.MIN_EXPRESSION_FILES,
    ingestion_date: str | None = None, schema: str = delimited.COUNT_SCHEMA,
    naming: str = "{file_id}.tsv", file_id: str = delimited.FILE_STEM,
) -> str:
    """Count files named after their id in a folder: those that are listed and have landed.

    Fewer than ``minimum`` files are an error. ``limit`` cuts the listing, on request only. The files are counted in the
    table of their lines, so the rows are parsed and written once, into the slice.
    """
    listing, paths = _listed_files(spark, files, limit, folder, naming)
    what = "the expression read"
    if not paths:
        raise ValueError(f"{what} has none of the listed files")
    counts = delimited.scan_count_tsv(spark, paths, schema, file_id)
    tagged = delimited.tag_file_lineage(counts, listing, ["case_id", "submitter_id"])
    guard_min_groups(tagged, "file_id", minimum, what)
    return write_bronze_slice(tagged, layer_path(root, "bronze", "gdc_rna_seq_counts"), ingestion_date)


@cleans_up
def ingest_methylation(
    spark: SparkSession, root: str, files: DataFrame, folder: str,
    limit: int | None = None, ingestion_date: str | None = None,
    naming: str = "{file_id}.txt", file_id: str = delimited.FILE_STEM,
) -> str:
    contracts.validate(files, contracts.FILE_METADATA)
    listing, paths = _listed_files(spark, files, limit, folder, naming)
    if not paths:
        raise ValueError("the methylation read has none of the listed files")
    betas = delimited.scan_beta_tsv(spark, paths, file_id=file_id)
    tagged = delimited.tag_file_lineage(betas, listing, ["case_id", "submitter_id", "file_name"])
    return _published(tagged, layer_path(root, "bronze", "gdc_methylation_beta_values"), ingestion_date)


@cleans_up
def ingest_environmental(
    spark: SparkSession, root: str, path: str, end: dt.date, places: DataFrame | None = None,
    days: int = defaults.LOOKBACK_DAYS, ingestion_date: str | None = None,
) -> str:
    """All columns of the records are kept."""
    payload = records.scan_json_envelope(spark, path, PM25_RECORD, keep_all=True)
    recent = delimited.date_lookback_range(payload, "date_local", end, days, places)
    # a reading that is no number must not pass as a missing one
    df = recent.withColumn("arithmetic_mean", F.col("arithmetic_mean").cast("double"))
    return _published(df, layer_path(root, "bronze", "environmental_pm25"), ingestion_date, contracts.PM25)


@cleans_up
def ingest_seer(
    spark: SparkSession, root: str, path: str, ingestion_date: str | None = None,
    layout: Sequence[tuple[str, int, int]] = tuple(defaults.REGISTRY_LAYOUT), na_values: Sequence[str] = (),
) -> str:
    df = delimited.scan_fixed_width(spark, path, layout, na_values)
    return _published(df, layer_path(root, "bronze", "seer_extract"), ingestion_date, contracts.REGISTRY)

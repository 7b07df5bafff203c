"""Small lookup tables and value lists kept in YAML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom import defaults


def load_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)


def scan_yaml_lookup(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """A list of mappings under ``key`` as a table."""
    return spark.createDataFrame(load_yaml(path)[key], schema)


def gene_pathways(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(defaults.GENE_PATHWAYS, "gene string, pathway string")

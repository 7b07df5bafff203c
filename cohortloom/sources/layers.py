"""Domain tables of a bronze / silver / gold lake, stored as Parquet directories."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.runtime import folder_entries, path_exists, remove_path, shuffles_go

LAYERS = ("bronze", "silver", "gold")
SLICE = "ingestion_date"
CODEC = "zstd"  # ids and digests are most of a table, and snappy leaves them as they are


def layer_path(root: str, layer: str, domain: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{domain}"


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def slice_dates(spark: SparkSession, path: str) -> list[str]:
    """Dates of the slices of a bronze table, from its folder names alone."""
    return sorted(n.split("=", 1)[1] for n in folder_entries(spark, path) if n.startswith(f"{SLICE}="))


def scan_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    slices: str = "all",
) -> DataFrame:
    """Read a table; ``slices`` is ``"all"``, ``"latest"`` or one ISO date.

    The slice column stays a string, and choosing a slice prunes partitions.
    """
    # a later slice may have columns that an earlier one lacks
    schema = schema or spark.read.option("mergeSchema", True).parquet(path).schema
    if SLICE in schema.names:
        schema = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name == SLICE else f.dataType, f.nullable) for f in schema]
        )
    df = spark.read.schema(schema).parquet(path)
    if slices == "all":
        return df
    wanted = slices
    if slices == "latest":
        dates = slice_dates(spark, path)
        if not dates:
            raise ValueError(f"no slices under {path}")
        wanted = dates[-1]
    return df.filter(F.col(SLICE) == wanted)


def write_bronze_slice(df: DataFrame, path: str, ingestion_date: str | None = None) -> str:
    """Replace the slice of one date and leave every other slice alone.

    Running twice with the same input leaves one copy. An empty frame is refused, and a write that fails leaves the
    table as it was.
    """
    spark = df.sparkSession
    stamp = ingestion_date or dt.date.today().isoformat()
    existed = table_exists(spark, path)
    folder = f"{path}/{SLICE}={stamp}"
    before = folder_entries(spark, folder)
    try:
        with shuffles_go(spark):
            (
                df.withColumn(SLICE, F.lit(stamp))
                .write.partitionBy(SLICE)
                .mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", CODEC)
                .parquet(path)
            )
    except Exception:
        if not existed:
            remove_path(spark, path)
        raise
    # an empty frame writes no file and so replaces no slice; asking it beforehand
    # would compute it twice
    if folder_entries(spark, folder) <= before:
        if not existed:
            remove_path(spark, path)
        raise ValueError(f"the slice for {path} has no rows")
    return path


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a derived table together with its schema."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_go(df.sparkSession):
        writer.parquet(path)
    return path


def write_split(df: DataFrame, path: str, split_col: str = "split") -> str:
    """Store train and test rows as two folders of one table."""
    return overwrite_table(df, path, [split_col])

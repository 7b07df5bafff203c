"""Train / test split by patient."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.reshape import dedupe_by_key
from cohortloom.runtime import attach, materialize

PREFIX = 4  # hex digits of the hash: up to 65,536 classes per stratum


def patient_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def assign_split(
    df: DataFrame,
    id_col: str,
    stratify_col: str,
    test_size: float = 0.2,
    random_state: int = 42,
    order_by: Sequence[str] = (),
    split_col: str = "split",
) -> DataFrame:
    """Add ``train`` / ``test``; all rows of a patient are on the same side.

    Patients are ordered by a seeded hash of their id, and the first
    ``round(test_size * n)`` of each stratum are test. The same seed gives the same
    split on any partitioning. A patient with two strata takes the first in
    ``order_by``. Rows without an id are dropped.

    No stratum is ever sorted as a whole: counts per hash prefix show in which
    class the border of a stratum falls, and only that class is ranked.
    """
    known = df.filter(F.col(id_col).isNotNull())
    patients = materialize(
        dedupe_by_key(known, id_col, [stratify_col], list(order_by) or [stratify_col]).select(
            F.col(id_col).alias("__id"),
            F.col(stratify_col).alias("__stratum"),
            patient_hash(id_col, random_state).alias("__h"),
        ),
        "patients",
    )
    borders = materialize(_borders(patients, test_size), "borders")
    sides = attach(patients, borders, ["__stratum"]).select(
        F.col("__id").alias(id_col), F.when(F.col("__h") <= F.col("__last"), "test").otherwise("train").alias(split_col)
    )
    return known.join(sides, id_col, "inner").select(*df.columns, split_col)


def _borders(patients: DataFrame, test_size: float) -> DataFrame:
    """(stratum, hash of the last test patient); an empty text when there is none."""
    classes = patients.withColumn("__p", F.substring("__h", 1, PREFIX)).groupBy("__stratum", "__p").count()
    upto = Window.partitionBy("__stratum").orderBy("__p")
    whole = Window.partitionBy("__stratum")
    placed = classes.select(
        "__stratum",
        "__p",
        F.sum("count").over(upto).alias("__upto"),
        (F.sum("count").over(upto) - F.col("count")).alias("__before"),
        F.round(F.lit(test_size) * F.sum("count").over(whole)).cast("long").alias("__take"),
    )
    # the class that holds the last test patient, and how many of it are test
    edge = materialize(
        placed.filter((F.col("__before") < F.col("__take")) & (F.col("__upto") >= F.col("__take"))).select(
            "__stratum", "__p", (F.col("__take") - F.col("__before")).alias("__rest")
        ),
        "edge",
    )
    inside = attach(
        patients.withColumn("__p", F.substring("__h", 1, PREFIX)), edge, ["__stratum", "__p"]
    ).filter(F.col("__rest").isNotNull())
    rank = F.row_number().over(Window.partitionBy("__stratum", "__p").orderBy("__h"))
    last = inside.withColumn("__rank", rank).filter(F.col("__rank") == F.col("__rest"))
    return last.select("__stratum", F.col("__h").alias("__last"))


def patient_level_split(
    df: DataFrame,
    id_col: str,
    stratify_col: str,
    test_size: float = 0.2,
    random_state: int = 42,
    order_by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames of :func:`assign_split`."""
    split = materialize(assign_split(df, id_col, stratify_col, test_size, random_state, order_by, "__split"), "split")
    return (
        split.filter(F.col("__split") == "train").drop("__split"),
        split.filter(F.col("__split") == "test").drop("__split"),
    )

"""Column-wise casts, renames, flags and fills."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.DoubleType, T.IntegerType, T.LongType)


def select_keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def sanitized_names(names: Sequence[str], keep: Sequence[str] = ()) -> list[str]:
    """Non-word characters become ``_``; a name already taken gets a number."""
    taken = {n for n in names if n in keep}
    result = []
    for name in names:
        if name in keep:
            result.append(name)
            continue
        base = clean = re.sub(r"\W", "_", name)
        n = 1
        while clean in taken:
            n += 1
            clean = f"{base}_{n}"
        taken.add(clean)
        result.append(clean)
    return result


def sanitize_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*sanitized_names(df.columns, keep))


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in types.items()})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def add_missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_was_missing": F.col(c).isNull() for c in columns})


def fill_categorical_unknown(df: DataFrame, columns: Sequence[str], placeholder: str = "Unknown") -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(placeholder)) for c in columns})


def flag_genomic_not_tested(df: DataFrame, mutation_status_col: str) -> DataFrame:
    """A call that is absent was not tested, which is not the same as unmutated."""
    return fill_categorical_unknown(df, [mutation_status_col], "not_tested")


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(columns))


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def derive_event(df: DataFrame, status_col: str, output_col: str = "event") -> DataFrame:
    """1 when the status text starts with ``1``, otherwise 0, also for no status."""
    return df.withColumn(output_col, F.when(F.col(status_col).startswith("1"), 1).otherwise(0))

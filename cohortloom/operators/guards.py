"""Refusals: inputs that are too small to go on with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def guard_not_empty(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def guard_min_groups(df: DataFrame, group_col: str, minimum: int, what: str = "input") -> DataFrame:
    """Require at least ``minimum`` distinct non-null values, e.g. source files."""
    groups = df.filter(df[group_col].isNotNull()).select(group_col).distinct().count()
    if groups < minimum:
        raise ValueError(f"{what} has {groups} distinct {group_col}, needs at least {minimum}")
    return df


def guard_min_columns(columns: Sequence[str], minimum: int, what: str = "input") -> None:
    if len(columns) < minimum:
        raise ValueError(f"{what} has {len(columns)} feature columns, needs at least {minimum}")

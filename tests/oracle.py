"""Runs a registered query and its SQL and compares columns and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    names = sorted(pdf.columns)
    columns = [[_plain(v) for v in pdf[n].astype(object).tolist()] for n in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    """None when both hold the same rows."""
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} and {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"{len(spark_pdf)} and {len(duck_pdf)} rows"
    left, right = rows_of(spark_pdf), rows_of(duck_pdf)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None

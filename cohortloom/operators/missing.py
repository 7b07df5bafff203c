"""Imputation within strata and fills along time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.ordered import BUCKET, cut_ranges
from cohortloom.operators.quantiles import quantile_name, quantile_table
from cohortloom.runtime import attach, materialize


def impute_numeric_stratified(
    df: DataFrame, columns: Sequence[str], strata_cols: Sequence[str], method: str = "approx"
) -> DataFrame:
    """Fill nulls with the lower median of the row's stratum.

    Null strata form one stratum; a stratum without any value stays null.
    """
    medians = quantile_table(df, columns, [0.5], strata_cols, method)
    joined = attach(df, medians, strata_cols)
    filled = {
        c: F.coalesce(F.col(c), F.get(quantile_name(c), F.lit(0)).cast(df.schema[c].dataType)) for c in columns
    }
    return joined.withColumns(filled).select(*df.columns)


def fill_environmental_nearest(
    df: DataFrame,
    value_col: str,
    county_col: str | Sequence[str],
    date_col: str,
    tie_cols: Sequence[str] = (),
    method: str = "ffill",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Fill gaps of a place from its own other readings.

    ``ffill`` takes the last reading before the gap. ``nearest`` takes the reading
    nearest in time on either side, the earlier one when both are equally near.
    ``tie_cols`` make the order within a date definite; the order of the input follows them, so that the rows of one
    date of one place may lie in several buckets. The input is written once.
    """
    places = [county_col] if isinstance(county_col, str) else list(county_col)
    if method not in ("ffill", "nearest"):
        raise ValueError(f"unknown fill method {method!r}")
    columns = df.columns
    df = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "readings")
    order = [date_col, *tie_cols, "__row"]
    ranges = cut_ranges(df, [*places, *order], rows_per_bucket)
    reading = F.when(F.col(value_col).isNotNull(), F.struct(F.col(value_col).alias("v"), F.col(date_col).alias("d")))
    placed = ranges.assign(df).withColumn("__reading", reading)

    here = Window.partitionBy(BUCKET, *places).orderBy(*order)
    before = F.last("__reading", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("__reading", ignorenulls=True).over(here.rowsBetween(0, Window.unboundedFollowing))
    both = method == "nearest"
    filled = placed.withColumns({"__prev": before, **({"__next": after} if both else {})})

    if ranges.cuts is not None:
        # one row per (place, bucket) carries the readings over the bucket borders
        at = F.struct(*order)
        seen = F.col("__reading").isNotNull()
        ends = placed.groupBy(*places, BUCKET).agg(
            F.max_by("__reading", F.when(seen, at)).alias("__last"),
            F.min_by("__reading", F.when(seen, at)).alias("__first"),
        )
        along = Window.partitionBy(*places).orderBy(BUCKET)
        earlier = F.last("__last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
        later = F.first("__first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
        carry = materialize(ends.select(*places, BUCKET, earlier.alias("__in"), later.alias("__out")), "carry")
        filled = attach(filled, carry, [*places, BUCKET]).withColumn("__prev", F.coalesce("__prev", "__in"))
        if both:
            filled = filled.withColumn("__next", F.coalesce("__next", "__out"))

    chosen: Column = F.col("__prev")
    if both:
        kind = df.schema[date_col].dataType
        gap_back = _distance(F.col("__prev.d"), F.col(date_col), kind)
        gap_on = _distance(F.col(date_col), F.col("__next.d"), kind)
        chosen = (
            F.when(F.col("__prev").isNull(), F.col("__next"))
            .when(F.col("__next").isNull() | (gap_back <= gap_on), F.col("__prev"))
            .otherwise(F.col("__next"))
        )
    return filled.withColumn(value_col, F.coalesce(F.col(value_col), chosen["v"])).select(*columns)


def _distance(start: Column, end: Column, kind: T.DataType) -> Column:
    """Time between two dates (days) or timestamps (microseconds)."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", start, end)
    return F.datediff(end.cast("date"), start.cast("date"))

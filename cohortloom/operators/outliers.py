"""Capping of implausible values and flagging of extreme ones."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import defaults
from cohortloom.operators.quantiles import global_mads, global_quantiles, quantile_name, quantile_table
from cohortloom.runtime import attach


def _capped(column: str, q1: Column, q3: Column, k: float) -> Column:
    x = F.col(column).cast("double")
    spread = F.lit(float(k)) * (q3 - q1)
    fenced = F.greatest(F.least(x, q3 + spread), q1 - spread)
    return F.when(x.isNotNull() & q1.isNotNull(), fenced).otherwise(x)


def cap_iqr(
    df: DataFrame,
    columns: Sequence[str],
    group_cols: Sequence[str] | None = None,
    k: float = 1.5,
    method: str = "approx",
) -> DataFrame:
    """Clamp to ``[q1 - k * iqr, q3 + k * iqr]`` of the row's group or of the column.

    A null stays null, and so does a column without fences.
    """
    if not group_cols:
        fences = global_quantiles(df, columns, [0.25, 0.75], method)
        capped = {}
        for c in columns:
            q1, q3 = fences[c]
            if q1 is not None:
                capped[c] = _capped(c, F.lit(q1), F.lit(q3), k)
        return df.withColumns(capped) if capped else df
    stats = quantile_table(df, columns, [0.25, 0.75], group_cols, method)
    joined = attach(df, stats, group_cols)
    capped = {c: _capped(c, *[F.get(quantile_name(c), F.lit(i)) for i in (0, 1)], k) for c in columns}
    return joined.withColumns(capped).select(*df.columns)


def flag_robust_zscore_outliers(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = defaults.ROBUST_Z_THRESHOLD,
    group_cols: Sequence[str] = (),
    method: str = "approx",
) -> DataFrame:
    """Add ``{column}_is_outlier``: distance to the median in scaled deviations.

    Values are flagged, never changed. A null value has a null flag. With
    ``group_cols`` median and deviation are those of the row's group.
    """
    if group_cols:
        return _flag_by_group(df, columns, threshold, list(group_cols), method)
    medians = {c: q[0] for c, q in global_quantiles(df, columns, [0.5], method).items()}
    mads = global_mads(df, medians, method)
    flags = {}
    for c in columns:
        if medians[c] is None or math.isnan(medians[c]):
            flags[f"{c}_is_outlier"] = F.lit(None).cast("boolean")
            continue
        scale = defaults.MAD_SCALE * (mads[c] or defaults.ZERO_MAD)
        flags[f"{c}_is_outlier"] = F.abs(F.col(c) - F.lit(medians[c])) / F.lit(scale) > F.lit(threshold)
    return df.withColumns(flags)


def _flag_by_group(
    df: DataFrame, columns: Sequence[str], threshold: float, group_cols: list[str], method: str
) -> DataFrame:
    deviation = {c: f"__dev_{c}" for c in columns}
    medians = quantile_table(df, columns, [0.5], group_cols, method)
    around = attach(df, medians, group_cols).withColumns(
        {deviation[c]: F.abs(F.col(c) - F.get(quantile_name(c), F.lit(0))) for c in columns}
    )
    mads = quantile_table(around, list(deviation.values()), [0.5], group_cols, method)
    joined = attach(around, mads, group_cols)
    flags = {}
    for c in columns:
        mad = F.nullif(F.get(quantile_name(deviation[c]), F.lit(0)), F.lit(0.0))
        scale = F.lit(defaults.MAD_SCALE) * F.coalesce(mad, F.lit(defaults.ZERO_MAD))
        flags[f"{c}_is_outlier"] = F.col(deviation[c]) / scale > F.lit(threshold)
    return joined.withColumns(flags).select(*df.columns, *flags)

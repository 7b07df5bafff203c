"""Running computations over a global (or per-group) order, without ever putting
a whole order or a whole group into one task.

The order is cut into ranges of the composite key ``(group, order columns)``.
The cut points are sampled once and written down, so every later use of them
assigns the same bucket to the same row. A window then works inside one
``(bucket, group)``, and a table with one row per ``(bucket, group)`` carries the
state from one bucket to the next. The input is read several times (count, sample,
carry, result): write it first when it is costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.runtime import attach, materialize

ROWS_PER_BUCKET = 50_000
MAX_BUCKETS = 65_536
DRAWS = 32
BUCKET = "__bucket"


@dataclass(frozen=True)
class Ranges:
    """Cut points of an order; ``cuts`` is None when one bucket is enough."""

    keys: tuple[str, ...]
    size: int
    cuts: DataFrame | None

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the bucket number: how many cut points are at or below the key.

        The cut points enter as a scalar subquery, and the binary search over them
        is a chain of plain projections that Spark compiles.
        """
        if self.cuts is None:
            return df.withColumn(BUCKET, F.lit(0))
        cuts, key = self.cuts.scalar(), F.col("__key")
        placed = df.withColumn("__key", _key(self.keys)).withColumn(BUCKET, F.lit(0))
        for halving in range(self.size.bit_length() - 1, -1, -1):
            here = F.col(BUCKET)
            ahead = here + F.lit(1 << halving)
            fits = (ahead <= F.lit(self.size)) & (F.get(cuts, ahead - 1) <= key)
            placed = placed.withColumn(BUCKET, F.when(fits, ahead).otherwise(here))
        return placed.drop("__key")


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keys)])


def cut_ranges(df: DataFrame, keys: Sequence[str], rows_per_bucket: int | None = None) -> Ranges:
    """Sample cut points so that a bucket holds about ``rows_per_bucket`` rows.

    More keys than needed are sampled and every ``DRAWS``-th of them cuts: single draws would leave gaps of many times
    the wanted size. Which rows are sampled changes only how even the buckets are, never a result.
    """
    rows = df.count()
    buckets = min(MAX_BUCKETS, -(-rows // (rows_per_bucket or ROWS_PER_BUCKET)))
    if buckets <= 1:
        return Ranges(tuple(keys), 0, None)
    picked = df.select(_key(keys).alias("k")).sample(fraction=min(1.0, DRAWS * buckets / rows), seed=17)
    step = max(1, round(DRAWS * min(1.0, rows / (DRAWS * buckets))))
    every = F.filter(F.array_sort(F.collect_list("k")), lambda _, i: i % step == step - 1)
    cuts = materialize(picked.agg(F.array_distinct(every).alias("cuts")), "cuts")
    return Ranges(tuple(keys), cuts.select(F.size("cuts")).first()[0], cuts)


def running_sums(
    df: DataFrame,
    order_cols: Sequence[str],
    value_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    prefix: str = "cum_",
    ranges: Ranges | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Inclusive running totals of ``value_cols`` in the order of ``order_cols``.

    ``order_cols`` must be a total order inside a group.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    ranges = ranges or cut_ranges(df, [*group_cols, *order_cols], rows_per_bucket)
    placed = ranges.assign(df)
    inside = (
        Window.partitionBy(BUCKET, *group_cols)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.withColumns({f"{prefix}{c}": F.sum(c).over(inside) for c in value_cols})
    if ranges.cuts is None:
        return summed.drop(BUCKET)
    # one row per (group, bucket): what all earlier buckets of the group add up to
    earlier = (
        Window.partitionBy(*(group_cols or [F.lit(0)]))
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy(*group_cols, BUCKET).agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    offsets = materialize(
        totals.select(*group_cols, BUCKET, *[F.sum(f"__t_{c}").over(earlier).alias(f"__o_{c}") for c in value_cols]),
        "offsets",
    )
    joined = attach(summed, offsets, [*group_cols, BUCKET])
    shifted = joined.withColumns(
        {f"{prefix}{c}": F.col(f"{prefix}{c}") + F.coalesce(F.col(f"__o_{c}"), F.lit(0)) for c in value_cols}
    )
    return shifted.drop(BUCKET, *[f"__o_{c}" for c in value_cols])


def ordered_prefix_sum(
    df: DataFrame,
    order_cols: Sequence[str],
    value_col: str,
    output_col: str = "prefix_sum",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Running total of one column over the whole table."""
    summed = running_sums(df, order_cols, [value_col], prefix="__cum_", rows_per_bucket=rows_per_bucket)
    return summed.withColumnRenamed(f"__cum_{value_col}", output_col)

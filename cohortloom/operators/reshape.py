"""Long tables to wide tables and vectors, unions and reductions to one row per key."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize


def pivot_long_to_wide(
    df: DataFrame,
    id_cols: Sequence[str],
    attribute_col: str,
    value_col: str,
    values: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One column per attribute holding its first non-null value.

    ``values`` names the attributes and saves the pass that finds them.
    ``order_by`` says which value is first when an attribute occurs twice.
    """
    grouped = df.groupBy(*id_cols)
    pivoted = grouped.pivot(attribute_col, list(values)) if values else grouped.pivot(attribute_col)
    if order_by:
        at = F.when(F.col(value_col).isNotNull(), F.struct(*order_by))
        return pivoted.agg(F.min_by(value_col, at))
    return pivoted.agg(F.first(value_col, ignorenulls=True))


def long_to_vector(
    df: DataFrame,
    id_col: str,
    attribute_col: str,
    value_col: str,
    attributes: Sequence[str],
    output_col: str = "features",
    missing: float = 0.0,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One dense vector per id, in the order of ``attributes``; absent is ``missing``.

    The long table is first reduced to one value per (id, attribute), so a group
    never collects more entries than there are attributes. Long ids are sorted and sent as 128 bits of hashes, and
    come back by a table of the ids, so it is read twice.
    """
    n = len(attributes)
    named = df.sparkSession.createDataFrame(list(zip(attributes, range(n))), f"`{attribute_col}` string, __i int")
    places = materialize(named, "places")  # of a known size: broadcast only if that is small
    value = F.col(value_col).cast("double")
    hashes = {"__id": F.xxhash64(id_col), "__id2": F.xxhash64(F.lit(1), F.col(id_col))}
    ids = materialize(df.select(id_col).distinct().withColumns(hashes), "ids")
    slot = [F.col("__id"), F.col("__id2"), F.col("__i")]
    if order_by:
        one: Column = F.min_by(value, F.when(value.isNotNull(), F.struct(*order_by)))
        # the least of a struct is taken from sorted rows: a number in front that tells most slots apart spares comparisons
        slot.insert(0, F.xxhash64("__id", "__i").alias("__slot"))
    else:
        one = F.first(value, ignorenulls=True)
    cells = (
        df.withColumns(hashes)
        .join(places, attribute_col)
        .groupBy(*slot)
        .agg(one.alias("__v"))
        .select("__id", "__id2", F.struct("__i", F.coalesce("__v", F.lit(missing)).alias("__v")).alias("__cell"))
    )
    packed = cells.groupBy("__id", "__id2").agg(F.array_sort(F.collect_list("__cell")).alias("__cells"))
    gaps = F.array_except(F.sequence(F.lit(0), F.lit(n - 1)), F.col("__cells.__i"))
    empty = F.transform(gaps, lambda i: F.struct(i.alias("__i"), F.lit(missing).cast("double").alias("__v")))
    filled = F.array_sort(F.concat("__cells", empty))
    # most ids have every attribute: then the sorted cells are the vector
    slots = F.when(F.size("__cells") == n, F.col("__cells.__v")).otherwise(F.transform(filled, lambda c: c["__v"]))
    return packed.join(ids, ["__id", "__id2"]).select(id_col, array_to_vector(slots).alias(output_col))


def dedupe_by_key(df: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row per key in a stated order, reduced to the given columns."""
    first = F.min_by(F.struct(*columns), F.struct(*order_by)).alias("__first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"__first.{c}").alias(c) for c in columns])


def union_by_name(tagged: Sequence[tuple[DataFrame, str]], tag_col: str = "source") -> DataFrame:
    """Union of frames with equal column names, each tagged by its source."""
    return _stacked([df.withColumn(tag_col, F.lit(tag)) for df, tag in tagged], gaps=False)


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name where a frame may lack columns of another."""
    return _stacked(frames, gaps=True)


def _stacked(frames: Sequence[DataFrame], gaps: bool) -> DataFrame:
    return functools.reduce(lambda above, below: above.unionByName(below, allowMissingColumns=gaps), frames)

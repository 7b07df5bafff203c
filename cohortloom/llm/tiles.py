"""Comparing all members of a group with each other in pieces of bounded size.

A group is cut into blocks by a hash of the member; a *tile* is a pair of blocks. Every task then sees whole tiles, and
a group of any size becomes many of them. Members travel once per block of their own group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize


def with_tiles(df: DataFrame, group: str, member: str, block: int, weight: str | None = None) -> DataFrame:
    """Every row once per tile it takes part in, with ``tile`` (binary key), ``first`` and ``second``.

    ``first`` and ``second`` tell whether the row belongs to the tile's first and second block; a tile of a block with
    itself has rows for which both hold. A group has as many blocks as its rows, or the sum of ``weight``, need to stay
    near ``block`` each. ``df`` is read twice and should be a written table. Groups of one row are left out.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = materialize(
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("__n"), F.ceil(size / F.lit(block)).cast("int").alias("__blocks"))
        .filter("__n > 1")
        .select(group, "__blocks"),
        "sizes",
    )
    joined = df.join(sizes, group)
    own = F.pmod(F.xxhash64(member), F.col("__blocks").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    placed = joined.withColumn("__own", own).withColumn("__other", other)
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    return (
        placed.withColumn("tile", F.unhex(F.md5(F.concat_ws(":", F.hex(F.col(group)), low, high))))
        .withColumn("first", F.col("__own") == low)
        .withColumn("second", F.col("__own") == high)
        .drop("__blocks", "__own", "__other")
    )


def with_large_tiles(df: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """Every row once per ``tile`` (a number) it takes part in; only groups of more than ``block`` rows are cut.

    A tile of two blocks holds all rows of both, so rows of one block meet again in each of its tiles. Meant for many
    small groups: they are neither counted into a join nor shuffled here. ``group`` must be a number.
    """
    sizes = materialize(
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > block)
        .select(group, F.ceil(F.col("__n") / F.lit(block)).cast("int").alias("__blocks")),
        "sizes",
    )
    own = F.pmod(F.xxhash64(member), F.col("__blocks").cast("long")).cast("int")
    others = F.coalesce(F.sequence(F.lit(0), F.col("__blocks") - 1), F.array(F.lit(-1)))
    placed = df.join(sizes, group, "left").withColumn("__own", own).withColumn("__other", F.explode(others))
    cut = F.xxhash64(group, F.least("__own", "__other"), F.greatest("__own", "__other"))
    return placed.withColumn("tile", F.when(F.col("__own").isNull(), F.col(group)).otherwise(cut)).drop(
        "__blocks", "__own", "__other"
    )


def gathered(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key together and in one task, in runs."""
    return df.repartition(F.col(key)).sortWithinPartitions(key)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, as one table each; only the current run is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.array(batch.column(batch.schema.get_field_index(key)).to_pylist(), dtype=object)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)

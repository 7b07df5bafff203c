"""A bitmap of fixed size that keeps most unwanted rows out of a shuffle."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
_BUCKET_BITS = 32_768  # what one row of bitmap_construct_agg covers


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def split_by(df: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key's bit is set by a key of ``wanted`` (all that match, and few others), and the rest.

    The bitmap has 2^26 bits (8 MiB) at any size of ``wanted``, so it may be broadcast. The more keys there are, the
    more rows pass; a join must follow for those. Only keys go to Python, not the rows they belong to.
    """
    placed = wanted.select(_place(key).alias("place")).distinct()
    rows = (
        # bit positions are counted from 1 on: bucket 1 holds 1 to 32,768
        placed.groupBy(F.bitmap_bucket_number(F.col("place") + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros(BITS // 8, np.uint8)
    for row in rows:
        low = (row["bucket"] - 1) * _BUCKET_BITS // 8
        bitmap[low : low + _BUCKET_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def marked(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return df.filter(marked(_place(key))), df.filter(~marked(_place(key)))


def probably_in(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The first half of :func:`split_by`."""
    return split_by(df, wanted, key)[0]

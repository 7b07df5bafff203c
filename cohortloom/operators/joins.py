"""Equi-joins. A side is broadcast only by its size: stored tables have one that Catalyst
knows, lookups are measured first. All others are shuffled, and adaptive execution
splits the partitions of hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.runtime import materialize


def distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def join_broadcast_attributes(
    samples: DataFrame, attributes: DataFrame, patient_col: str, sample_col: str
) -> DataFrame:
    """Repeat each patient-level row on every sample of that patient."""
    return distinct_pairs(samples, [patient_col, sample_col]).join(attributes, patient_col, "inner")


def join_left_lookup(
    df: DataFrame, lookup: DataFrame, key: str, value_col: str, default: str | None = None
) -> DataFrame:
    """Add ``value_col`` by key; keys that are not listed get ``default``."""
    joined = df.join(materialize(lookup.select(key, value_col), "lookup"), key, "left")
    if default is None:
        return joined
    return joined.withColumn(value_col, F.coalesce(value_col, F.lit(default)))


def join_left_composite(df: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on several equal columns."""
    return df.join(right, list(keys), "left")


def semi_join_isin(df: DataFrame, keys: DataFrame, key_col: str) -> DataFrame:
    """Rows whose key is in a computed set of keys."""
    return df.join(keys.select(key_col), key_col, "left_semi")


def intersect_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def key_overlap(tables: dict[str, DataFrame], key_col: str) -> DataFrame:
    """Row, key and overlap counts: (measure, n) for each table, pair and triple.

    The key sets stay distributed: each table is reduced to its distinct keys, one
    grouped pass marks which tables hold a key, and one aggregate counts the marks.
    """
    names = list(tables)
    tagged = None
    for i, name in enumerate(names):
        counted = (
            tables[name]
            .groupBy(F.col(key_col).alias("k"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("k", *[(F.col("n") if j == i else F.lit(0)).cast("long").alias(f"r{j}") for j in range(len(names))])
        )
        tagged = counted if tagged is None else tagged.unionByName(counted)
    per_key = tagged.groupBy("k").agg(*[F.sum(f"r{j}").alias(f"r{j}") for j in range(len(names))])

    measures = {f"rows:{n}": F.sum(f"r{j}") for j, n in enumerate(names)}
    # distinct keys as a set would count them: a null key is one more value
    held = [F.col(f"r{j}") > 0 for j in range(len(names))]
    for size in range(1, len(names) + 1):
        for combo in _combinations(len(names), size):
            label = ("keys:" if size == 1 else "overlap:") + "&".join(names[j] for j in combo)
            both = held[combo[0]]
            for j in combo[1:]:
                both = both & held[j]
            measures[label] = F.count_if(both)
    row = per_key.agg(*[F.coalesce(m, F.lit(0)).cast("long").alias(k) for k, m in measures.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(f"`{k}`").alias("n")) for k in measures])
    return row.select(F.inline(pairs))


def _combinations(n: int, size: int) -> list[tuple[int, ...]]:
    import itertools

    return list(itertools.combinations(range(n), size))


def county_exposure(
    readings: DataFrame,
    county_col: str = "county_code",
    date_col: str = "date_local",
    value_col: str = "arithmetic_mean",
    output_col: str = "pm25_annual_mean",
) -> DataFrame:
    """Average reading per county and year, the year being a string."""
    return (
        readings.groupBy(county_col, F.substring(date_col, 1, 4).alias("year"))
        .agg(F.avg(value_col).alias(output_col))
    )


def with_county_exposure(people: DataFrame, exposure: DataFrame, county_col: str = "county_code") -> DataFrame:
    """Left join of yearly exposure; the written exposure table has a known size."""
    return join_left_composite(people, materialize(exposure, "exposure"), [county_col, "year"])

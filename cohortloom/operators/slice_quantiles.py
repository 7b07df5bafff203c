"""Exact quantiles over all slices of a growing table, where only a new slice is read.

A slice leaves two small tables behind when it comes: a KLL sketch per group, and its distinct values in order with the
number of its rows up to each. The sketches of all slices, merged, say between which values a wanted rank lies; there,
and from the nearest step below on, the rows of the second table are read, and the running total over the slices names
the element. A slice whose values all lie elsewhere adds a number and no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.ordered import running_sums
from cohortloom.runtime import all_of, any_of, materialize

KLL_K = 1024  # normalised rank error of about 0.3 %
MARGIN = 0.01
STEP = 1000  # distinct values from one step to the next
MAX_FILTERS = 64
PART = "part"


def write_rank_slice(df: DataFrame, column: str, group_cols: Sequence[str], path: str, part: str) -> str:
    """Leave the sketches and ranks of one slice under ``path``; the slice's rows are read here and never again.

    Nulls and NaN are no values. A null group is a group. Writing a slice again replaces it.
    """
    keys = [f"__g{i}" for i in range(len(group_cols))]
    value = F.col(column).cast("double")
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys)], value.alias("__v"))
    counts = materialize(
        rows.filter("__v is not null and not isnan(__v)").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")), "counts"
    )
    # a value of many rows stands in the sketch once for each, so the sketch is of the rows
    sketches = rows.filter("__v is not null and not isnan(__v)").groupBy(*keys).agg(
        F.kll_sketch_agg_double("__v", F.lit(KLL_K)).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.min("__v").alias("least"),
        F.max("__v").alias("largest"),
    )
    ordered = running_sums(counts.withColumn("__one", F.lit(1)), ["__v"], ["__n", "__one"], keys)
    # the order of the files gives every row group a narrow range of values
    ranked = ordered.select(
        *keys, "__v", F.col("__n").alias("n"), F.col("cum___n").alias("upto"), (F.col("cum___one") % STEP == 0).alias("step")
    )
    for name, table in (("sketches", sketches), ("ranks", ranked.repartitionByRange(*keys, "__v").sortWithinPartitions(*keys, "__v"))):
        writer = table.withColumn(PART, F.lit(part)).write.partitionBy(PART).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{name}")
    return path


def quantiles_of_slices(
    sketches: DataFrame, ranks: DataFrame, group_cols: Sequence[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Group columns plus one column per wanted quantile, over all slices of the two tables of :func:`write_rank_slice`.

    A quantile is an element of the data: the smallest value whose rank is at least ``p * n``. Only the rows of ``ranks``
    near a wanted rank are read; should the sketch's error pass the margin, the ranges are widened until they hold it.
    """
    keys = [f"__g{i}" for i in range(len(group_cols))]
    merged = materialize(
        sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("sketch"), F.sum("n").alias("n")), "merged"
    )
    margin = MARGIN
    while True:
        ranges = materialize(_ranges(merged, keys, probabilities, margin), "ranges")
        found = materialize(_found(ranges, sketches, ranks, keys), "found")
        if margin >= 1 or found.filter("not sure").isEmpty():
            break
        margin *= 8
    table = found.groupBy(*keys).pivot("i", list(range(len(probabilities)))).agg(F.first("q"))
    return table.select(
        *[F.col(k).alias(c) for c, k in zip(group_cols, keys)], *[F.col(str(i)).alias(n) for i, n in enumerate(names)]
    )


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return all_of([left[k].eqNullSafe(right[k]) for k in keys]) if keys else F.lit(True)


def _ranges(merged: DataFrame, keys: list[str], probabilities: Sequence[float], margin: float) -> DataFrame:
    """(keys, ``i``, ``target``, ``low``, ``high``): each wanted rank, and the values between which it should lie."""
    everything = margin >= 1
    at = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, p))))
    wanted = [
        F.struct(
            F.lit(i).alias("i"),
            F.greatest(F.ceil(F.lit(float(p)) * F.col("n")), F.lit(1)).alias("target"),
            (F.lit(float("-inf")) if everything else at(p - margin)).alias("low"),
            (F.lit(float("inf")) if everything else at(p + margin)).alias("high"),
        )
        for i, p in enumerate(probabilities)
    ]
    return merged.select(*keys, F.explode(F.array(*wanted)).alias("w")).select(*keys, "w.*")


def _found(ranges: DataFrame, sketches: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ``i``, ``q``, ``sure``): the element of each wanted rank, and whether the range read holds it."""
    # the step of each slice from which its rows are read, and the rows up to there
    steps = ranks.filter("step").select(*keys, PART, "__v", "upto").alias("s")
    r = ranges.alias("r")
    below = r.join(steps, _same(ranges, steps, keys) & (F.col("s.__v") < F.col("r.low")))
    starts = below.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys], F.col("r.i").alias("i"), F.col(f"s.{PART}").alias(PART)).agg(
        F.max("s.__v").alias("start"), F.max("s.upto").alias("base")
    )
    slices = sketches.select(*keys, PART, "least", "largest", F.col("n").alias("rows")).alias("t")
    held = r.join(slices, _same(ranges, slices, keys)).select("r.*", f"t.{PART}", "t.least", "t.largest", "t.rows")
    s2 = starts.alias("s2")
    h = held.alias("h")
    on = _same(held, starts, [*keys, "i", PART])
    placed = h.join(s2, on, "left").select("h.*", F.col("s2.start"), F.col("s2.base"))
    # a slice that ends below the range counts whole, one that begins behind it not at all
    whole = F.col("largest") < F.col("low")
    placed = materialize(
        placed.select(
            *keys, "i", PART, "target", "high",
            F.when(whole, F.lit(float("inf"))).otherwise(F.coalesce("start", F.lit(float("-inf")))).alias("start"),
            F.when(whole, F.col("rows")).otherwise(F.coalesce("base", F.lit(0))).alias("base"),
        ),
        "placed",
    )
    bases = placed.groupBy(*keys, "i").agg(F.sum("base").alias("base"), F.max("target").alias("target"))
    reading = placed.filter("start < high")
    # few enough ranges are pushed down to the files
    bounds = reading.groupBy(*keys).agg(F.min("start").alias("a"), F.max("high").alias("b")).limit(MAX_FILTERS + 1).collect()
    source = ranks
    if bounds and len(bounds) <= MAX_FILTERS:
        source = ranks.filter(any_of([all_of([*[F.col(k).eqNullSafe(F.lit(b[k])) for k in keys], F.col("__v") >= b["a"], F.col("__v") <= b["b"]]) for b in bounds]))
    v, p = source.alias("v"), reading.alias("p")
    near = v.join(p, _same(source, reading, [*keys, PART]) & (F.col("v.__v") > F.col("p.start")) & (F.col("v.__v") <= F.col("p.high")))
    per_value = near.groupBy(*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p.i").alias("i"), F.col("v.__v").alias("__v")).agg(F.sum("v.n").alias("c"))
    summed = running_sums(materialize(per_value, "near"), ["__v"], ["c"], [*keys, "i"]).alias("u")
    b = bases.alias("b")
    reached = F.col("u.cum_c") + F.col("b.base") >= F.col("b.target")
    return (
        b.join(summed, _same(bases, summed, [*keys, "i"]), "left")
        .groupBy(*[F.col(f"b.{k}").alias(k) for k in keys], F.col("b.i").alias("i"))
        .agg(
            F.min(F.when(reached, F.col("u.__v"))).alias("q"),
            ((F.max("b.base") < F.max("b.target")) & F.coalesce(F.max(reached), F.lit(False))).alias("sure"),
        )
    )

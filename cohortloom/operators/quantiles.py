"""Order statistics per group or for whole columns, in bounded memory.

``method="approx"`` is one aggregate with a bounded sketch per group.
``method="exact"`` uses the sketch only to find a narrow slice around each wanted
rank; a second aggregate counts what lies outside the slices as a few totals and
what lies inside by value, and the wanted element is read from their running totals, which
are taken in ranges. No task ever holds the values of a whole group. Whole columns are
sketched and counted side by side, and only rows that lie in a slice become rows per value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.ordered import running_sums
from cohortloom.runtime import any_of, attach, materialize

SKETCH_ACCURACY = 10_000
KLL_K = 65_535  # of whole columns: ranks to about one in ten thousand


def quantile_name(column: str) -> str:
    """Name of the array column that holds the quantiles of ``column``."""
    return f"__q_{column}"


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    group_cols: Sequence[str] = (),
    method: str = "approx",
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group, read from a written table, with an array of quantiles per column.

    A quantile is an element of the data: the smallest value whose rank is at
    least ``p * n``. Nulls are ignored; a group without values gives nulls.
    """
    if method == "approx":
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        stats = df.groupBy(*group_cols).agg(
            *[
                F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(quantile_name(c))
                for c in columns
            ]
        )
        return materialize(stats, "quantiles")
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    if not group_cols:
        return _exact_whole(df, list(columns), list(probabilities), accuracy)
    return _exact_table(df, list(columns), list(probabilities), list(group_cols), accuracy)


def _exact_whole(df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int) -> DataFrame:
    """One row with an array per column. The driver sees counts and the slices' edges, one row of them a pass."""
    spark, places = df.sparkSession, range(len(columns))
    doubles = df.select(*[F.col(c).cast("double").alias(f"__{i}") for i, c in enumerate(columns)])
    stats = [
        (F.kll_sketch_agg_double(c, KLL_K).alias(f"s{c}"), F.count(c).alias(f"n{c}"), F.count_if(F.isnan(c)).alias(f"x{c}"))
        for c in doubles.columns
    ]
    sketches = materialize(doubles.agg(*[a for column in stats for a in column]), "sketch")
    row = sketches.select(*[f"{kind}{c}" for c in doubles.columns for kind in "nx"]).first()
    n, nans = ([row[f"{kind}{c}"] or 0 for c in doubles.columns] for kind in "nx")
    found: dict[tuple[int, float], float] = {}
    wanted = [(i, p) for i in places if n[i] for p in dict.fromkeys(probabilities)]
    margin = 4.0 / accuracy
    while wanted:
        edges = _edges(sketches, wanted, n, nans, margin)
        target = [max(1, math.ceil(p * n[i])) for i, p in wanted]
        found |= {wanted[k]: q for k, q in _inside(doubles, wanted, edges, target).items()}
        # a slice missed its rank: widen it and look again
        wanted, margin = [w for w in wanted if w not in found], margin * 16
    values = [[found.get((i, p)) for p in probabilities] for i in places]
    return spark.createDataFrame([values], ", ".join(f"`{quantile_name(c)}` array<double>" for c in columns))


def _edges(
    sketches: DataFrame, wanted: list[tuple[int, float]], n: list[int], nans: list[int], margin: float
) -> list[tuple[float, float]]:
    """The least and the greatest value of a slice around each wanted rank; the sketch leaves NaN out, the greatest of all."""
    if margin >= 1.0:
        return [(-math.inf, math.nan)] * len(wanted)
    numbers = [n[i] - nans[i] for i, _ in wanted]
    ranks = [tuple((p + side) * n[i] / max(1, m) for side in (-margin, margin)) for (i, p), m in zip(wanted, numbers)]
    read = [
        F.array(*[F.kll_sketch_get_quantile_double(f"s__{i}", F.lit(min(1.0, max(0.0, r)))) for r in both]).alias(str(k))
        for k, ((i, _), both, m) in enumerate(zip(wanted, ranks, numbers))
        if m
    ]
    row = sketches.select(*read).first().asDict() if read else {}
    edges = []
    for k, (i, _) in enumerate(wanted):
        low, high = row.get(str(k), (math.nan, math.nan))
        edges.append((low, math.nan if nans[i] and ranks[k][1] >= 1.0 else high))
    return edges


def _inside(
    doubles: DataFrame, wanted: list[tuple[int, float]], edges: list[tuple[float, float]], target: list[int]
) -> dict[int, float]:
    """The element of each target rank, by the slice's number, where the slice holds it."""
    column = [F.col(f"__{i}") for i, _ in wanted]
    lower = [F.count_if(c < low).alias(str(k)) for k, (c, (low, _)) in enumerate(zip(column, edges))]
    below = list(doubles.agg(*lower).first())
    within = [c.between(low, high) for c, (low, high) in zip(column, edges)]
    held = F.array(*[F.when(hit, F.struct(F.lit(k).alias("__slice"), c.alias("__v"))) for k, (hit, c) in enumerate(zip(within, column))])
    rows = doubles.filter(any_of(within)).select(F.explode(F.array_compact(held)).alias("r")).select("r.*")
    counts = materialize(rows.groupBy("__slice", "__v").agg(F.count(F.lit(1)).alias("__c")), "counts")
    ranked = running_sums(counts, ["__v"], ["__c"], ["__slice"])
    need = F.get(F.array(*[F.lit(t - b) for t, b in zip(target, below)]), F.col("__slice"))
    picked = ranked.filter(F.col("cum___c") >= need).groupBy("__slice").agg(F.min("__v").alias("__q"))
    # one row per slice; a rank below the slice is none of its own
    return {r["__slice"]: r["__q"] for r in picked.collect() if target[r["__slice"]] > below[r["__slice"]]}


def _exact_table(
    df: DataFrame, columns: list[str], probabilities: list[float], group_cols: list[str], accuracy: int
) -> DataFrame:
    keys = [f"__g{i}" for i in range(len(group_cols))]
    values = df.select(
        *[F.col(c).alias(k) for c, k in zip(group_cols, keys)],
        F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("__col", "__v"),
    ).filter(F.col("__v").isNotNull())

    margin = 4.0 / accuracy
    while True:
        picked = materialize(_pick(values, keys, probabilities, margin, accuracy), "picked")
        if margin >= 1.0 or picked.filter(~F.col("__sure")).isEmpty():
            break
        margin = min(1.0, margin * 16)  # a slice missed its rank: widen it and look again

    table = picked.groupBy(*keys).pivot("__col", list(range(len(columns)))).agg(F.first("__q"))
    return table.select(
        *[F.col(k).alias(c) for c, k in zip(group_cols, keys)],
        *[F.col(str(i)).alias(quantile_name(c)) for i, c in enumerate(columns)],
    )


def _pick(values: DataFrame, keys: list[str], probabilities: list[float], margin: float, accuracy: int) -> DataFrame:
    edges = [min(1.0, max(0.0, p + side)) for p in probabilities for side in (-margin, margin)]
    sketch = materialize(
        values.groupBy(*keys, "__col").agg(
            F.percentile_approx("__v", F.array(*[F.lit(e) for e in edges]), accuracy).alias("__edges"),
            F.count("__v").alias("__n"),
        ),
        "sketch",
    )
    marked = attach(values, sketch, [*keys, "__col"])
    lows = [F.get("__edges", F.lit(2 * i)) for i in range(len(probabilities))]
    highs = [F.get("__edges", F.lit(2 * i + 1)) for i in range(len(probabilities))]
    if margin >= 1.0:
        inside = F.lit(True)
    else:
        inside = any_of([F.col("__v").between(lo, hi) for lo, hi in zip(lows, highs)])
    gap = sum((F.when(F.col("__v") > hi, 1).otherwise(0) for hi in highs), F.lit(0))

    # inside a slice: one row per value; between slices: one row in all
    counts = materialize(
        marked.withColumn("__slot", F.when(inside, F.col("__v")))
        .withColumn("__gap", F.when(F.col("__slot").isNull(), gap))
        .groupBy(*keys, "__col", "__n", "__gap", "__slot")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__pos")),
        "counts",
    )
    ranked = running_sums(counts, ["__pos"], ["__c"], [*keys, "__col"])
    picks, sure = [], []
    for p in probabilities:
        reached = F.col("cum___c") >= F.greatest(F.ceil(F.lit(float(p)) * F.col("__n")), F.lit(1))
        picks.append(F.min(F.when(reached, F.col("__pos"))))
        sure.append(F.min_by(F.col("__slot").isNotNull(), F.when(reached, F.col("__pos"))))
    result = ranked.groupBy(*keys, "__col").agg(F.array(*picks).alias("__q"), F.array(*sure).alias("__s"))
    return result.select(*keys, "__col", "__q", F.forall("__s", lambda s: s).alias("__sure"))


def quantiles_grouped(
    df: DataFrame,
    column: str,
    group_cols: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    names: Sequence[str] = ("q1", "median", "q3"),
    method: str = "exact",
) -> DataFrame:
    """Group columns plus one column per wanted quantile."""
    table = quantile_table(df, [column], probabilities, group_cols, method)
    arr = quantile_name(column)
    return table.select(*group_cols, *[F.get(arr, F.lit(i)).alias(n) for i, n in enumerate(names)])


def global_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], method: str = "exact"
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns as plain numbers: one row reaches the driver."""
    row = quantile_table(df, columns, probabilities, (), method).first()
    empty = [None] * len(probabilities)
    return {c: list((row and row[quantile_name(c)]) or empty) for c in columns}


def quantiles_global(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    names: Sequence[str] = ("q1", "median", "q3"),
    method: str = "exact",
) -> DataFrame:
    """One row per column with its quantiles."""
    table = quantile_table(df, columns, probabilities, (), method)
    rows = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(quantile_name(c)).alias("q")) for c in columns])
    )
    return table.select(rows.alias("r")).select(
        "r.column", *[F.get("r.q", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def global_mads(
    df: DataFrame, medians: dict[str, float | None], method: str = "exact"
) -> dict[str, float | None]:
    """Median absolute deviation of every column around its given median."""
    known = {c: m for c, m in medians.items() if m is not None and not math.isnan(m)}
    if not known:
        return dict.fromkeys(medians)
    deviations = df.select(*[F.abs(F.col(c).cast("double") - F.lit(m)).alias(c) for c, m in known.items()])
    mads = global_quantiles(deviations, list(known), [0.5], method)
    return {c: mads[c][0] if c in known else None for c in medians}


def mad_global(df: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    """One row per column: its median and median absolute deviation."""
    medians = {c: q[0] for c, q in global_quantiles(df, columns, [0.5], method).items()}
    mads = global_mads(df, medians, method)
    return df.sparkSession.createDataFrame(
        [(c, medians[c], mads[c]) for c in columns], "column string, median double, mad double"
    )

"""Ranking metrics over the whole data: pairs are counted, never built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.ordered import running_sums
from cohortloom.runtime import materialize


def _product(a: Column, b: Column) -> Column:
    """Exact product of two counts."""
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def _score_cells(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label_col).cast("long")
    cells = (
        df.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(score_col).cast("double").alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )
    return materialize(cells, "scores")


def roc_auc(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, equal scores counting half."""
    ranked = running_sums(_score_cells(df, score_col, label_col), ["score"], ["neg"])
    halves = _product(F.col("pos"), 2 * F.col("cum_neg") - F.col("neg"))
    totals = ranked.agg(F.sum(halves).alias("h"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.nullif(_product(F.col("p"), F.col("n")).cast("double"), F.lit(0.0))
    return totals.select((F.col("h").cast("double") / 2 / pairs).alias("roc_auc"))


def average_precision(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Precision at each distinct score, weighted by the recall gained there."""
    cells = _score_cells(df, score_col, label_col).withColumn("down", -F.col("score"))
    ranked = running_sums(cells, ["down"], ["pos", "neg"])
    gained = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    totals = ranked.agg(F.sum(gained).alias("g"), F.sum("pos").alias("p"))
    return totals.select((F.col("g") / F.nullif(F.col("p"), F.lit(0))).alias("average_precision"))


def concordance_index(df: DataFrame, duration_col: str, event_col: str, risk_col: str) -> DataFrame:
    """One row: (concordance, comparable, concordant); equal risks count half.

    A pair is comparable when the earlier time is an event, an event counting as
    earlier than a censoring at the same time; it is concordant when the earlier
    one has the higher risk.

    Times are numbered in that order. Two numbers first differ in exactly one
    binary digit, so every comparable pair meets in exactly one (digit, common
    higher digits) node, the earlier member on its 0 side. Within a node the pairs
    are counted by running totals along the risk. The work is n log n rows.
    """
    cells = materialize(
        df.select(
            F.col(duration_col).cast("double").alias("t"),
            (1 - F.col(event_col).cast("int")).alias("censored"),
            F.col(risk_col).cast("double").alias("risk"),
        )
        .dropna()
        .groupBy("t", "censored", "risk")
        .agg(F.count(F.lit(1)).alias("w")),
        "cells",
    )
    moments = materialize(cells.select("t", "censored").distinct().withColumn("one", F.lit(1)), "moments")
    numbered = materialize(
        running_sums(moments, ["t", "censored"], ["one"]).select("t", "censored", (F.col("cum_one") - 1).alias("m")),
        "numbered",
    )
    digits = max(1, (numbered.count() - 1).bit_length())
    placed = cells.join(numbered, ["t", "censored"]).withColumn(
        "digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1)))
    )
    late = F.call_function("shiftright", F.col("m"), F.col("digit")) % 2 == 1
    sided = placed.select(
        "digit",
        F.call_function("shiftright", F.col("m"), F.col("digit") + 1).alias("node"),
        "risk",
        F.when(~late & (F.col("censored") == 0), F.col("w")).otherwise(0).alias("early"),
        F.when(late, F.col("w")).otherwise(0).alias("late"),
    ).filter((F.col("early") > 0) | (F.col("late") > 0))
    nodes = materialize(
        sided.groupBy("digit", "node", "risk").agg(F.sum("early").alias("early"), F.sum("late").alias("late")),
        "nodes",
    )
    along = running_sums(nodes, ["risk"], ["late"], group_cols=["digit", "node"])
    lower = F.col("cum_late") - F.col("late")
    right = along.agg(
        F.sum(_product(F.col("early"), 2 * lower + F.col("late"))).alias("halves"),
    )
    pairs = (
        nodes.groupBy("digit", "node")
        .agg(F.sum("early").alias("early"), F.sum("late").alias("late"))
        .agg(F.sum(_product(F.col("early"), F.col("late"))).alias("pairs"))
    )
    halves, comparable = right.first()["halves"], pairs.first()["pairs"]
    score = None if not comparable else float(halves) / 2 / float(comparable)
    return df.sparkSession.createDataFrame(
        [(score, int(comparable or 0), float(halves or 0) / 2)],
        "concordance double, comparable long, concordant double",
    )

"""Proportional hazards with a ridge penalty, fitted by Newton steps on Spark.

With ``w = exp(x b)`` a step needs, for each event time, the sums of ``w`` and ``w x``
over those still at risk. Rows are summed per distinct time, and the sums are
accumulated from the latest time to the earliest. Ties follow Efron: the d deaths
of a time leave the risk set one after the other, in shares.

The second-order term ``sum_t c(t) sum_{T >= t} w x x'`` is regrouped by row: each row
counts ``w x x'`` as often as the cumulated ``c`` up to its own time. So rows only
need one scalar per time, and only p x p sums reach the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.ordered import Ranges, cut_ranges, running_sums
from cohortloom.runtime import materialize

PENALIZER = 0.1
DEATHS_A_BLOCK = 10_000
SHARES = "c0 double, c1 double, c2 double, e1 double, e2 double, e3 double"


@dataclass(frozen=True)
class CoxModel:
    """Coefficients on the scale of the covariates, and their training means."""

    covariates: tuple[str, ...]
    means: tuple[float, ...]
    coefficients: tuple[float, ...]
    standard_errors: tuple[float, ...]
    objective: float
    steps: int

    def write(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CoxModel:
        stored = json.loads(spark.read.text(path).first()["value"])
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in stored.items()})

    def summary(self, spark: SparkSession) -> DataFrame:
        rows = [
            (c, b, math.exp(b), s) for c, b, s in zip(self.covariates, self.coefficients, self.standard_errors)
        ]
        return spark.createDataFrame(rows, "covariate string, coef double, hazard_ratio double, se double")


def partial_hazard(model: CoxModel, df: DataFrame, output_col: str = "partial_hazard") -> DataFrame:
    """Add ``exp(b (x - mean))``."""
    terms = [
        F.lit(b) * (F.col(c).cast("double") - F.lit(m))
        for c, b, m in zip(model.covariates, model.coefficients, model.means)
    ]
    return df.withColumn(output_col, F.exp(sum(terms, F.lit(0.0))))


def train_coxph(
    train: DataFrame,
    duration_col: str,
    event_col: str,
    covariate_cols: Sequence[str],
    penalizer: float = PENALIZER,
    max_steps: int = 50,
    tolerance: float = 1e-7,
) -> CoxModel:
    """Maximise ``loglik / n - penalizer / 2 * |b|^2`` over standardised covariates."""
    names = list(covariate_cols)
    p = len(names)
    rows = train.select(
        F.col(duration_col).cast("double").alias("t"),
        F.col(event_col).cast("double").alias("e"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)],
    ).dropna()
    moments = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(p)],
        *[F.stddev_samp(f"x{i}").alias(f"s{i}") for i in range(p)],
    ).first()
    n = moments["n"]
    means = np.array([moments[f"m{i}"] for i in range(p)], dtype=float)
    scales = np.array([moments[f"s{i}"] or 1.0 for i in range(p)], dtype=float)
    design = materialize(
        rows.select(
            "t", "e", (-F.col("t")).alias("back"),
            *[((F.col(f"x{i}") - F.lit(float(means[i]))) / F.lit(float(scales[i]))).alias(f"x{i}") for i in range(p)],
        ),
        "design",
    )
    event_sum = design.agg(*[F.sum(F.col("e") * F.col(f"x{i}")).alias(f"x{i}") for i in range(p)]).first()
    event_x = np.array([event_sum[f"x{i}"] for i in range(p)], dtype=float)
    times = materialize(design.groupBy("t", "back").agg(F.sum("e").alias("d")), "times")
    hot = (times.agg(F.max("d")).first()[0] or 0) > DEATHS_A_BLOCK
    ranges = cut_ranges(times, ["back"]), cut_ranges(times, ["t"])

    def evaluate(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loglik, gradient, hessian = _derivatives(design, b, event_x, ranges, hot)
        return (
            loglik / n - penalizer / 2 * float(b @ b),
            gradient / n - penalizer * b,
            hessian / n - penalizer * np.eye(p),
        )

    beta = np.zeros(p)
    value, gradient, hessian = evaluate(beta)
    steps = 0
    while steps < max_steps:
        delta = np.linalg.solve(-hessian, gradient)
        if np.max(np.abs(delta)) < tolerance:
            break
        steps += 1
        trial = beta + delta
        found = evaluate(trial)
        while found[0] < value - 1e-12 * abs(value) and np.max(np.abs(trial - beta)) >= tolerance:
            trial = (trial + beta) / 2
            found = evaluate(trial)
        beta, (value, gradient, hessian) = trial, found
    errors = np.sqrt(np.diag(np.linalg.inv(-hessian * n))) / scales
    return CoxModel(
        tuple(names), tuple(means.tolist()), tuple((beta / scales).tolist()), tuple(errors.tolist()), float(value), steps
    )


def _derivatives(
    design: DataFrame, beta: np.ndarray, event_x: np.ndarray, ranges: tuple[Ranges, Ranges], hot: bool
) -> tuple[float, np.ndarray, np.ndarray]:
    p = len(beta)
    eta: Column = sum((F.lit(float(b)) * F.col(f"x{i}") for i, b in enumerate(beta)), F.lit(0.0))
    weighted = design.withColumn("w", F.exp(eta))
    risk = ["r", *[f"r{i}" for i in range(p)]]
    per_time = weighted.groupBy("t", "back").agg(
        F.sum("w").alias("r"),
        *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"r{i}") for i in range(p)],
        F.sum("e").alias("d"),
        F.sum(F.col("e") * F.col("w")).alias("q"),
        *[F.sum(F.col("e") * F.col("w") * F.col(f"x{i}")).alias(f"q{i}") for i in range(p)],
    )
    if ranges[0].cuts is not None:
        per_time = materialize(per_time, "pertime")
    at_risk = running_sums(per_time, ["back"], risk, ranges=ranges[0])
    shared = _with_shares(at_risk, hot)
    if ranges[1].cuts is not None:
        shared = materialize(shared, "shared")
    table = materialize(running_sums(shared, ["t"], ["c1"], ranges=ranges[1]), "timetable")

    from_times = table.filter("d > 0").select(
        "c0", "c1", "c2", "e1", "e2", "e3",
        F.array(*[F.col(f"cum_r{i}") for i in range(p)]).alias("r"),
        F.array(*[F.col(f"q{i}") for i in range(p)]).alias("q"),
    )
    lived = table.select("t", "cum_c1", "c2")
    from_rows = weighted.join(lived, "t").select(
        (F.col("w") * (F.col("cum_c1") - F.col("e") * F.col("c2"))).alias("v"),
        F.array(*[F.col(f"x{i}") for i in range(p)]).alias("x"),
    )
    parts = from_times.mapInPandas(_time_sums(p), "i int, v double").union(
        from_rows.mapInPandas(_row_sums(p), "i int, v double")
    )
    sums = np.zeros(p * p + p + 1)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # p * p + p + 1 rows
        sums[row["i"]] = row["v"]
    event_eta = float(event_x @ beta)
    return event_eta - sums[-1], event_x - sums[p * p : p * p + p], sums[: p * p].reshape(p, p)


def _with_shares(at_risk: DataFrame, hot: bool) -> DataFrame:
    """The times with their Efron sums. The deaths of a time form blocks, and where a time has several (``hot``), they
    are dealt to the tasks one by one."""
    share = _efron_shares(F.col("cum_r"), F.col("q"), F.col("d"), F.col("block"))
    if not hot:
        one = at_risk.withColumn("block", F.lit(0)).withColumn("s", share)
        return one.select("*", "s.*").drop("s", "block")
    at_risk = materialize(at_risk, "atrisk")
    last = F.floor(F.greatest(F.col("d") - 1, F.lit(0)) / DEATHS_A_BLOCK).cast("int")
    blocks = at_risk.select("t", "cum_r", "q", "d", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    names = ["c0", "c1", "c2", "e1", "e2", "e3"]
    sums = (
        blocks.repartition("t", "block")
        .withColumn("s", share)
        .groupBy("t")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in names])
    )
    return at_risk.join(sums, "t")


def _efron_shares(at_risk: Column, dying: Column, deaths: Column, block: Column) -> Column:
    """Sums over a block of the d steps of a tied time, with ``f = l / d`` and
    ``z = at_risk - f * dying``: log z, 1/z, f/z, 1/z^2, f/z^2, f^2/z^2."""

    def shares(at_risk: pd.Series, dying: pd.Series, deaths: pd.Series, block: pd.Series) -> pd.DataFrame:
        import numpy as np
        import pandas as pd

        d = deaths.to_numpy().astype(np.int64)
        start = block.to_numpy().astype(np.int64) * DEATHS_A_BLOCK
        size = np.clip(d - start, 0, DEATHS_A_BLOCK)
        some = np.flatnonzero(size)
        # the steps of all rows in one run
        first = np.cumsum(size[some]) - size[some]
        owner = np.repeat(some, size[some])
        f = (start[owner] + np.arange(int(size.sum())) - np.repeat(first, size[some])) / d[owner]
        z = at_risk.to_numpy()[owner] - f * dying.to_numpy()[owner]
        out = np.zeros((len(d), 6))
        if len(some):
            for k, term in enumerate((np.log(z), 1 / z, f / z, 1 / z**2, f / z**2, f**2 / z**2)):
                out[some, k] = np.add.reduceat(term, first)
        return pd.DataFrame(out, columns=["c0", "c1", "c2", "e1", "e2", "e3"])

    return F.pandas_udf(shares, SHARES)(at_risk, dying, deaths, block)


def _time_sums(p: int):
    """Per partition of the time table: outer products, gradient and log part."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        total = np.zeros(p * p + p + 1)
        for pdf in batches:
            if not len(pdf):
                continue
            r, q = np.stack(pdf["r"].to_numpy()), np.stack(pdf["q"].to_numpy())
            c0, c1, c2, e1, e2, e3 = (pdf[c].to_numpy() for c in ("c0", "c1", "c2", "e1", "e2", "e3"))
            cross = (r * e2[:, None]).T @ q
            outer = (r * e1[:, None]).T @ r - cross - cross.T + (q * e3[:, None]).T @ q
            total[: p * p] += outer.ravel()
            total[p * p : p * p + p] += c1 @ r - c2 @ q
            total[-1] += c0.sum()
        yield pd.DataFrame({"i": np.arange(len(total), dtype="int32"), "v": total})

    return run


def _row_sums(p: int):
    """Per partition of the rows: the negative weighted sum of ``x x'``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        total = np.zeros((p, p))
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                total -= (x * pdf["v"].to_numpy()[:, None]).T @ x
        yield pd.DataFrame({"i": np.arange(p * p, dtype="int32"), "v": total.ravel()})

    return run

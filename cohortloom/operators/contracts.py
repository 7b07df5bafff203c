"""Declared table contracts, checked in one aggregate pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.runtime import any_of


@dataclass(frozen=True)
class Rule:
    """What one column must look like; ``kind`` None accepts any type."""

    column: str
    kind: str | None = "string"
    nullable: bool = False
    ge: float | None = None
    isin: tuple | None = None


@dataclass(frozen=True)
class Contract:
    """Rules for the columns a table must have; further columns are allowed."""

    name: str
    rules: tuple[Rule, ...]


class ContractViolation(ValueError):
    """All failed checks of a frame, each as (column, check, failures)."""

    def __init__(self, contract: Contract, failures: list[tuple[str, str, int]]):
        self.failures = failures
        listed = "; ".join(f"{column} {check}: {n}" for column, check, n in failures)
        super().__init__(f"contract {contract.name} violated: {listed}")


# The contracts of the raw inputs.
CLINICAL = Contract(
    "clinical",
    (
        Rule("sampleId"),
        Rule("patientId"),
        Rule("clinicalAttributeId"),
        Rule("value", nullable=True),
    ),
)
MUTATIONS = Contract(
    "mutations",
    (
        Rule("sampleId"),
        Rule("gene", kind=None),
        Rule("proteinChange", nullable=True),
        Rule("mutationType", nullable=True),
    ),
)
FILE_METADATA = Contract("file_metadata", (Rule("file_id"), Rule("file_name"), Rule("data_type", nullable=True)))
METHYLATION = Contract("methylation", (Rule("file_id"), Rule("file_name"), Rule("case_id", kind=None, nullable=True)))
PM25 = Contract(
    "pm25",
    (
        Rule("state_code"),
        Rule("county_code"),
        Rule("date_local"),
        Rule("arithmetic_mean", kind="double", nullable=True, ge=0),
    ),
)
REGISTRY = Contract(
    "registry",
    (
        Rule("patient_id_number"),
        Rule("sex", nullable=True, isin=("1", "2")),
        Rule("age_at_diagnosis", nullable=True),
        Rule("vital_status", nullable=True, isin=("0", "1", "4")),
    ),
)


def _fits(kind: T.DataType, wanted: str | None) -> bool:
    return wanted is None or kind.simpleString() == wanted


def _value_checks(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(column, check, condition of a bad row) for every check on values.

    A null fails only the not-null check.
    """
    checks = []
    for rule in contract.rules:
        if rule.column not in df.columns:
            continue
        c = F.col(rule.column)
        if not rule.nullable:
            checks.append((rule.column, "not_null", c.isNull()))
        if not _fits(df.schema[rule.column].dataType, rule.kind):
            continue
        if rule.ge is not None:
            checks.append((rule.column, "ge", F.coalesce(c < F.lit(rule.ge), F.lit(False))))
        if rule.isin is not None:
            checks.append((rule.column, "isin", F.coalesce(~c.isin(list(rule.isin)), F.lit(False))))
    return checks


def _checks(df: DataFrame, contract: Contract, only: Sequence[str] | None) -> tuple[list, list]:
    """Checks on the schema with their outcome, and checks on values with the condition of a bad row."""
    static = []
    for rule in contract.rules:
        there = rule.column in df.columns
        static.append((rule.column, "exists", 0 if there else 1))
        if there and rule.kind is not None:
            static.append((rule.column, "type", 0 if _fits(df.schema[rule.column].dataType, rule.kind) else 1))
    static = [s for s in static if only is None or s[1] in only]
    return static, [c for c in _value_checks(df, contract) if only is None or c[1] in only]


def _counts(checks: list) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(checks)]]


def contract_report(df: DataFrame, contract: Contract, only: Sequence[str] | None = None) -> DataFrame:
    """One row per check: (column, check, failures, rows).

    ``only`` restricts the report to some kinds of check. Schema checks fail once;
    value checks fail once per bad row.
    """
    static, checks = _checks(df, contract, only)
    if not static and not checks:
        return df.sparkSession.createDataFrame([], "column string, check string, failures long, rows long")
    counted = df.agg(*_counts(checks))
    lines = [(column, check, F.lit(n).cast("long")) for column, check, n in static]
    lines += [(column, check, F.col(f"f{i}")) for i, (column, check, _) in enumerate(checks)]
    entries = [
        F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"), n.alias("failures"), F.col("rows"))
        for column, check, n in lines
    ]
    return counted.select(F.inline(F.array(*entries)))


class Watch:
    """The checks of a contract, counted by whatever job uses ``df`` first, without a pass of their own."""

    def __init__(self, df: DataFrame, contract: Contract):
        self.contract = contract
        self.static, self.checks = _checks(df, contract, None)
        self._seen = Observation()
        self.df = df.observe(self._seen, *_counts(self.checks))

    def rows(self) -> list[tuple[str, str, int, int]]:
        """(column, check, failures, rows), once the job has run."""
        seen = self._seen.get
        lines = [*self.static, *[(column, check, seen[f"f{i}"]) for i, (column, check, _) in enumerate(self.checks)]]
        return [(column, check, n, seen["rows"]) for column, check, n in lines]

    def validate(self) -> None:
        """Raise all failures together."""
        failed = [(column, check, n) for column, check, n, _ in self.rows() if n]
        if failed:
            raise ContractViolation(self.contract, failed)


def contract_columns(df: DataFrame, contract: Contract) -> DataFrame:
    return contract_report(df, contract, ["exists", "type"])


def contract_not_null(df: DataFrame, contract: Contract) -> DataFrame:
    return contract_report(df, contract, ["not_null"])


def contract_check_ge(df: DataFrame, contract: Contract) -> DataFrame:
    return contract_report(df, contract, ["ge"])


def contract_check_isin(df: DataFrame, contract: Contract) -> DataFrame:
    return contract_report(df, contract, ["isin"])


def validate(df: DataFrame, contract: Contract, raise_on_fail: bool = True) -> DataFrame:
    """Run every check, and report or raise all failures together."""
    report = contract_report(df, contract)
    if raise_on_fail:
        failed = report.filter("failures > 0").collect()  # at most one row per check
        if failed:
            raise ContractViolation(contract, [(r["column"], r["check"], r["failures"]) for r in failed])
    return report


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Split a frame into rows that pass all value checks and rows that do not."""
    conditions = [bad for _, _, bad in _value_checks(df, contract)]
    if not conditions:
        return df, df.limit(0)
    bad = any_of(conditions)
    return df.filter(~bad), df.filter(bad)

"""Issues, the publication gate and the row-rule engine."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.session import counted


class DataError(RuntimeError):
    """A fatal issue was found; nothing may be published."""


class Loaded(NamedTuple):
    """Good rows and the issues found beside them."""

    rows: DataFrame
    issues: DataFrame


class Rule(NamedTuple):
    """``broken`` is the predicate of a violation; null counts as kept."""

    rule_id: str
    broken: Column
    message: str


def issues_of(df: DataFrame, code: Column, reason: Column, detail: Column | None = None,
              severity: str = "fatal") -> DataFrame:
    """Rows of ``df`` with a non-null reason, as issues."""
    detail = F.lit(None) if detail is None else detail
    return df.select(
        code.cast("string").alias("code"), reason.cast("string").alias("reason"),
        detail.cast("string").alias("detail"), F.lit(severity).alias("severity"),
    ).where(F.col("reason").isNotNull())


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def violations(df: DataFrame, rules: list[Rule], key: Column) -> DataFrame:
    """One row per broken rule and input row, in a single pass."""
    checks = [
        F.when(rule.broken, F.struct(F.lit(rule.rule_id).alias("rule_id"),
                                     F.lit(rule.message).alias("message")))
        for rule in rules
    ]
    hits = df.select(key.cast("string").alias("key"),
                     F.explode(F.array_compact(F.array(*checks))).alias("hit"))
    return hits.select("hit.rule_id", "key", "hit.message")


def gate_status(issues: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row: fatal issues, ranked records and whether the run may be published."""
    fatal = issues.agg(F.count_if(F.col("severity") == "fatal").alias("fatal_count"))
    records = ranked.agg(F.count(F.lit(1)).alias("record_count"))
    both = fatal.withColumn("one", F.lit(1)).join(records.withColumn("one", F.lit(1)), "one")
    return both.select(
        "fatal_count", "record_count",
        ((F.col("fatal_count") == 0) & (F.col("record_count") > 0)).alias("publishable"),
    )


class Gate(NamedTuple):
    """DQ-01 with what it judged: the staged tables, which hold the rows that were counted."""

    fatal_count: int
    record_count: int
    issues: DataFrame
    ranked: DataFrame

    @property
    def publishable(self) -> bool:
        return self.fatal_count == 0 and self.record_count > 0

    def check(self) -> None:
        """Raise when a fatal issue exists or both lists are empty."""
        if not self.publishable:
            sample = self.issues.where("severity = 'fatal'").limit(5).collect()
            raise DataError(
                f"{self.fatal_count} fatal issues, {self.record_count} ranked records; "
                f"for example {[tuple(row) for row in sample]}"
            )


def staged_gate(issues: DataFrame, ranked: DataFrame) -> Gate:
    """DQ-01. Stage both tables and count them while they are written: each is computed once."""
    issues, found = counted(issues, fatal_count=F.count_if(F.col("severity") == "fatal"))
    ranked, listed = counted(ranked, record_count=F.count(F.lit(1)))
    return Gate(found["fatal_count"], listed["record_count"], issues, ranked)


def distinct_warnings(warnings: DataFrame) -> DataFrame:
    """Each text once, at the place where it first appeared."""
    return warnings.groupBy("text").agg(F.min("seq").alias("seq")).select("seq", "text")

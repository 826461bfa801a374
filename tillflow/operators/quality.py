"""Data-quality expectations: count, drop or fail.

A condition that is NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

KEEP, DROP, FAIL = "keep", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = KEEP

    def __post_init__(self) -> None:
        if self.action not in (KEEP, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))

    @property
    def violated(self) -> Column:
        return F.count_if(~self.met)


def enforce(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """Drop the rows that break a DROP rule; raise on a row that breaks a FAIL rule.

    The failing check is a filter: a check in an added column would disappear
    when nobody reads that column.
    """
    for rule in rules:
        if rule.action == FAIL:
            message = F.lit(f"expectation failed: {rule.name} ({rule.condition})")
            df = df.where(F.when(rule.met, True).otherwise(F.raise_error(message).cast("boolean")))
        elif rule.action == DROP:
            df = df.where(rule.met)
    return df


def watch(df: DataFrame, rules: Iterable[Expectation]) -> tuple[DataFrame, Observation]:
    """Count rows and violations while the rows flow to whatever action comes next.

    The numbers are right after an action that reads all rows, such as a write.
    """
    seen = Observation()
    counts = [rule.violated.alias(rule.name) for rule in rules]
    return df.observe(seen, F.count("*").alias("rows"), *counts), seen


def report(df: DataFrame, dataset: str, rules: list[Expectation]) -> DataFrame:
    """``dataset, expectation, action, rows, violations`` in one pass over ``df``."""
    counts = df.agg(
        F.count("*").alias("rows"), *[rule.violated.alias(f"_{i}") for i, rule in enumerate(rules)]
    )
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("expectation"),
            F.lit(rule.action).alias("action"),
            F.col("rows"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))

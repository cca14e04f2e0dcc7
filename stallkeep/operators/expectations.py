"""Declarative data-quality rules: warn, drop, fail, quarantine.

A rule is a name and a SQL condition. A condition that is NULL for a row counts
as broken: the row was not shown to be good.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = dict[str, str]


class ExpectationFailed(Exception):
    """Raised by the fail policy; `violations` maps rule to broken rows."""

    def __init__(self, dataset: str, violations: dict[str, int]):
        self.dataset = dataset
        self.violations = violations
        super().__init__(f"{dataset}: {violations}")


def holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def all_hold(rules: Rules) -> Column:
    combined = F.lit(True)
    for condition in rules.values():
        combined = combined & holds(condition)
    return combined


def _counters(rules: Rules) -> list[Column]:
    broken = [F.count_if(~holds(c)).alias(f"r{i}") for i, c in enumerate(rules.values())]
    return [F.count(F.lit(1)).alias("checked_rows"), F.count_if(~all_hold(rules)).alias("broken_rows"), *broken]


def expectation_metrics(df: DataFrame, rules: Rules, dataset: str) -> DataFrame:
    """One row per rule with the rows checked and broken, in one pass over `df`."""
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(name).alias("rule"),
            F.col("checked_rows").alias("checked_rows"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*_counters(rules)).select(F.inline(F.array(*rows)))


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that keep every rule."""
    return df.where(all_hold(rules))


def failed_rules(rules: Rules) -> Column:
    """The names of the rules a row breaks."""
    return F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~holds(c), F.lit(n)) for n, c in rules.items()]))


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, with `failed_rules` naming which."""
    return df.where(~all_hold(rules)).withColumn("failed_rules", failed_rules(rules))


def count_violations(df: DataFrame, rules: Rules) -> dict[str, int]:
    counts = df.agg(*_counters(rules)).first()
    return {name: counts[f"r{i}"] for i, name in enumerate(rules)}


def expect_or_fail(df: DataFrame, rules: Rules, dataset: str) -> DataFrame:
    """`df` unchanged, or ExpectationFailed when any row breaks a rule."""
    broken = {name: n for name, n in count_violations(df, rules).items() if n}
    if broken:
        raise ExpectationFailed(dataset, broken)
    return df


@dataclass
class Watch:
    """Counts rule violations of a frame while another action runs over it."""

    rules: Rules
    observation: Observation

    def violations(self) -> dict[str, int]:
        counts = self.observation.get
        return {name: counts[f"r{i}"] for i, name in enumerate(self.rules)}

    def checked_rows(self) -> int:
        return self.observation.get["checked_rows"]

    def broken_rows(self) -> int:
        """Rows that break a rule, whatever their number of rules."""
        return self.observation.get["broken_rows"]


def watch(df: DataFrame, rules: Rules) -> tuple[DataFrame, Watch]:
    """Attach the counters to `df`, so that writing it counts without a second pass.

    Write the returned frame directly: then the counting is part of the final
    stage, whose lost tasks are counted once.
    """
    observation = Observation()
    return df.observe(observation, *_counters(rules)), Watch(rules, observation)

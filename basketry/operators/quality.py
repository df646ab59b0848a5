"""Data-quality rules with three severities, quarantine and reports.

A rule is data: a name, a SQL predicate and what to do with a row that does not satisfy it. A row
satisfies a rule only if the predicate is TRUE; FALSE and NULL both violate it. Every function here
works on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"
VIOLATIONS = "_violations"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = DROP

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


@dataclass(frozen=True)
class Reason:
    """A message for rejected rows that meet ``condition``."""

    message: str
    condition: str


def having(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [rule for rule in rules if rule.action == action]


def all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [rule.holds() for rule in rules], F.lit(True))


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the rows that satisfy every drop rule."""
    return df.filter(all_hold(having(rules, DROP)))


def abort_on_violation(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Fail the query on the first row that violates a fail rule.

    The check is a filter, not a projected assertion: column pruning may remove an unused column but
    never a filter, so the check also runs under ``count()``.
    """
    for rule in having(rules, FAIL):
        message = f"rule {rule.name} violated: {rule.predicate}"
        alarm = F.raise_error(F.lit(message)).cast("boolean")
        df = df.filter(F.when(rule.holds(), F.lit(True)).otherwise(alarm))
    return df


def violated(rules: Sequence[Rule]) -> Column:
    """Names of the violated rules in rule order, as an array. Joined from constant arrays: to drop the
    NULLs of one array takes a lambda, which Spark interprets row by row."""
    none = F.array().cast("array<string>")
    return F.concat(
        none, *[F.when(~rule.holds(), F.array(F.lit(rule.name))).otherwise(none) for rule in rules])


def tagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the violated drop rules of each row, so both sides of a split come from one scan."""
    return df.withColumn(VIOLATIONS, violated(having(rules, DROP)))


def accepted(tagged_df: DataFrame) -> DataFrame:
    return tagged_df.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def rejected(tagged_df: DataFrame) -> DataFrame:
    return tagged_df.filter(F.size(VIOLATIONS) > 0)


def first_reason(reasons: Sequence[Reason], otherwise: str) -> Column:
    """Message of the first reason, in order, whose condition is TRUE."""
    return F.coalesce(
        *[F.when(F.expr(reason.condition), F.lit(reason.message)) for reason in reasons],
        F.lit(otherwise),
    )


def watched(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Attach violation counts to the run: ``observedMetrics`` of a stream's progress.

    The counters ride along with the query; no second pass is made.
    """
    counts = [F.count_if(~rule.holds()).alias(rule.name) for rule in rules]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counts)


def report(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule: table, rule, action, passed, failed. One aggregation over ``df``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(rule.holds()).alias(f"_ok_{i}") for i, rule in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.action).alias("action"),
                F.col(f"_ok_{i}").alias("passed"),
                (F.col("_rows") - F.col(f"_ok_{i}")).alias("failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))

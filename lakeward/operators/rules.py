"""Declarative row rules: keep, divert with a reason, warn, count.

A rule is a SQL boolean over the cleaned row.  One list of rules feeds every
output, so kept and diverted rows always partition the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

VALID = "valid"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Rule:
    """``passes`` is SQL; ``on_null`` says what an undecided (null) result means.

    ``action``: ``drop`` diverts the row, ``warn`` only counts, ``fail`` stops the job.
    """

    name: str
    passes: str
    reason: str
    on_null: str = "pass"
    action: str = "drop"

    def failed(self) -> Column:
        undecided = F.lit(self.on_null == "fail")
        return F.coalesce(~F.expr(self.passes), undecided)


def _with_action(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def _any_failed(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [r.failed() for r in rules], F.lit(False))


def first_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first failed rule in declared order, null when none failed."""
    return F.coalesce(*[F.when(r.failed(), F.lit(r.reason)) for r in rules], F.lit(None))


def all_reasons(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.reason)) for r in rules]))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Stop the job at the first row that breaks a ``fail`` rule."""
    strict = _with_action(rules, "fail")
    if not strict:
        return df
    broken = F.raise_error(F.concat(F.lit("rule failed: "), first_reason(strict)))
    return df.where(F.when(_any_failed(strict), broken.cast("boolean")).otherwise(F.lit(True)))


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no ``drop`` rule."""
    drops = _with_action(rules, "drop")
    if not drops:
        return enforce(df, rules)
    return enforce(df, rules).where(reduce(and_, [~r.failed() for r in drops]))


def divert(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a ``drop`` rule, with the first reason and all of them.

    The list of reasons is built after the filter, on the diverted rows only.
    """
    drops = _with_action(rules, "drop")
    return df.where(_any_failed(drops)).withColumns(
        {"error_reason": first_reason(drops), "error_reasons": all_reasons(drops)}
    )


def route(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Both outputs in one pass: adds ``_route`` and ``error_reason``.

    A table partitioned by ``_route`` gives the valid and the quarantine side as
    two pruned reads, without evaluating the rules twice.
    """
    drops = _with_action(rules, "drop")
    reason = first_reason(drops)
    return enforce(df, rules).withColumns(
        {
            "_route": F.when(reason.isNull(), F.lit(VALID)).otherwise(F.lit(QUARANTINE)),
            "error_reason": reason,
        }
    )


def warnings(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep every row; list the ``warn`` rules it breaks in ``_warnings``."""
    return df.withColumn("_warnings", all_reasons(_with_action(rules, "warn")))


def count_columns(rules: Sequence[Rule]) -> list[Column]:
    columns = []
    for rule in rules:
        columns.append(F.count_if(~rule.failed()).alias(f"{rule.name}__passed"))
        columns.append(F.count_if(rule.failed()).alias(f"{rule.name}__failed"))
    return columns


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_name, passed_records, failed_records): one scan, one row per task shuffled."""
    totals = df.agg(*count_columns(rules))
    entries = [
        F.struct(
            F.lit(r.name).alias("rule_name"),
            F.col(f"{r.name}__passed").alias("passed_records"),
            F.col(f"{r.name}__failed").alias("failed_records"),
        )
        for r in rules
    ]
    return totals.select(F.inline(F.array(*entries)))


def observed(df: DataFrame, rules: Sequence[Rule], name: str | Observation) -> DataFrame:
    """Count passes and failures as a by-product of whatever job runs the frame."""
    return df.observe(name, *count_columns(rules))


# --- predicates shared by the rule lists ------------------------------------------------


def not_null(column: str) -> str:
    return f"{column} IS NOT NULL"


def in_domain(column: str, values: Sequence[str]) -> str:
    """Membership; a null value stays undecided."""
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{column} IN ({listed})"


def matches(column: str, pattern: str) -> str:
    return f"{column} RLIKE '{pattern}'"


def differs(left: str, right: str) -> str:
    """Inequality; undecided when either side is null."""
    return f"{left} != {right}"


def parses(raw: str, parsed: str, optional: bool = False) -> str:
    """Text that was given must have parsed; ``optional`` lets missing text pass."""
    missing_ok = f"nullif(trim({raw}), '') IS NULL OR " if optional else ""
    return f"{missing_ok}{parsed} IS NOT NULL"

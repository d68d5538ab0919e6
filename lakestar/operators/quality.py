"""Data-quality rules: hard ones send rows to quarantine, soft ones flag them; counts are data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``predicate`` is SQL that is true for a row that fails."""

    name: str
    predicate: str
    severity: str = "flag"


def broken(rules: list[Rule], severity: str) -> Column:
    """Names of the failed rules, in rule order."""
    names = [F.when(F.expr(r.predicate), F.lit(r.name)) for r in rules if r.severity == severity]
    return F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")


def apply(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with dq_reasons (hard rules) and dq_flags (soft rules)."""
    return df.withColumns({"dq_reasons": broken(rules, "quarantine"), "dq_flags": broken(rules, "flag")})


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows for quarantine)."""
    judged = apply(df, rules)
    return judged.where(F.size("dq_reasons") == 0), judged.where(F.size("dq_reasons") > 0)


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, severity, failed, total of all rules, in one pass over ``df``."""
    row = df.agg(F.count("*").alias("total"), *(F.coalesce(F.sum(F.when(F.expr(r.predicate), 1).otherwise(0)), F.lit(0)).cast("long").alias(r.name) for r in rules))
    each = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(r.name).alias("failed")) for r in rules))
    return row.select("total", F.explode(each).alias("x")).select("x.rule", "x.severity", "x.failed", "total")

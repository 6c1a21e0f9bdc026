"""Rule-based cleaning and its reject report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.rules import Rule, accepts, first_failure


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every rule."""
    return df.where(accepts(rules))


def rejected(df: DataFrame, rules: Sequence[Rule], reason: str = "reason") -> DataFrame:
    """Rows that fail some rule, with the first failing rule; the complement of ``apply_rules``."""
    return df.withColumn(reason, first_failure(rules)).where(F.col(reason).isNotNull())


def reject_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule: rows failing it, and rows for which it is the first failing rule.

    Each row is reduced to a text with one digit per rule (1 = failed), and rows are counted
    per text before the shuffle. All counters follow from these few texts.
    """
    outcome = F.concat(*(F.when(r.passes(), "0").otherwise("1") for r in rules))
    patterns = df.groupBy(outcome.alias("_outcome")).agg(F.count(F.lit(1)).alias("_rows"))
    numbered = F.array(
        *(F.struct(F.lit(r.name).alias("rule"), F.lit(i + 1).alias("_place")) for i, r in enumerate(rules))
    )
    failed = F.substring("_outcome", F.col("_place"), F.lit(1)) == "1"
    first = F.instr("_outcome", "1") == F.col("_place")
    return (
        patterns.select("_outcome", "_rows", F.inline(numbered))
        .groupBy("rule")
        .agg(
            F.coalesce(F.sum(F.when(failed, F.col("_rows"))), F.lit(0)).alias("failing"),
            F.coalesce(F.sum(F.when(first, F.col("_rows"))), F.lit(0)).alias("first_failing"),
        )
    )


def violations(df: DataFrame, checks: Sequence[Rule]) -> DataFrame:
    """Per check: how many rows match it. Here the predicate describes the *bad* rows."""
    counters = [
        F.struct(F.lit(c.name).alias("check"), F.count_if(F.expr(c.predicate)).alias("violations"))
        for c in checks
    ]
    return df.agg(F.array(*counters).alias("_checks")).select(F.inline("_checks"))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)

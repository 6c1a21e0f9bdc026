"""Data-quality rules as data: a name and a SQL predicate that accepted rows satisfy.

A predicate that evaluates to NULL counts as a failure.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    predicate: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def not_null(*columns: str) -> Rule:
    return Rule("_".join(columns) + "_present", " AND ".join(f"{c} IS NOT NULL" for c in columns))


def member(column: str, values: Iterable[int]) -> Rule:
    return Rule(f"{column}_known", f"{column} IN ({', '.join(str(v) for v in values)})")


def positive(column: str) -> Rule:
    return Rule(f"{column}_positive", f"{column} > 0")


def non_negative(column: str) -> Rule:
    return Rule(f"{column}_non_negative", f"{column} >= 0")


def ordered(first: str, second: str) -> Rule:
    return Rule(f"{first}_before_{second}", f"{first} <= {second}")


def accepts(rules: Iterable[Rule]) -> Column:
    """Conjunction of all rules.

    The bare predicates go into the filter: a NULL drops the row there anyway, and
    simple comparisons can be pushed into the Parquet scan, unlike ``coalesce``.
    """
    return reduce(lambda left, right: left & right, (F.expr(r.predicate) for r in rules))


def first_failure(rules: Iterable[Rule]) -> Column:
    """Name of the first rule a row fails, NULL for an accepted row."""
    return F.coalesce(*(F.when(~r.passes(), F.lit(r.name)) for r in rules))

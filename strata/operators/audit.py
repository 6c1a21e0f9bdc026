"""Audits: named checks over a table, evaluated together in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import KEY_LENGTH


def increment_checks(required: str, key: str | None = None) -> dict[str, Column]:
    """Checks before publishing: some rows, no NULL in ``required``, and a unique key."""
    checks = {
        "has_rows": F.count(F.lit(1)) > 0,
        f"no_null_{required}": F.count_if(F.col(required).isNull()) == 0,
    }
    if key is not None:
        checks[f"unique_{key}"] = F.count_distinct(F.col(key)) == F.count(F.lit(1))
    return checks


def run_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with one boolean per check."""
    return df.agg(*(check.alias(name) for name, check in checks.items()))


def key_audit(df: DataFrame, key: str, length: int = KEY_LENGTH) -> DataFrame:
    """One row: rows, NULL keys, keys of the wrong length, distinct keys (NULL is one), duplicates, rate.

    Copies of a key are counted before the shuffle, so neither a hot key nor many NULLs
    pile up in one task.
    """
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    total, distinct = F.sum("_rows"), F.count(F.lit(1))
    return per_key.agg(
        F.coalesce(total, F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.length("_key") != length, F.col("_rows"))), F.lit(0)).alias("bad_length"),
        distinct.alias("distinct_keys"),
        F.coalesce(total - distinct, F.lit(0)).alias("duplicates"),
        F.coalesce(F.try_divide(distinct * 100.0, total), F.lit(0.0)).alias("uniqueness_pct"),
    )

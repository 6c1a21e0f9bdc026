"""Mergeable sketches per day: distinct counts and quantiles over any range of days without its rows.

Exact counts per day do not add up, because a key of two days would count twice; sketches do. Each has a stated
error, and the exact operators (``audit.key_audit``, ``quantiles.exact_quantiles``) stay beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the buckets of a distinct sketch, and three standard errors of its estimate.
DISTINCT_LG, DISTINCT_ERROR = 14, 3 * 1.04 / (1 << 7)
#: log2 of the entries of a set sketch, and three standard errors of a union's estimate.
SET_LG, SET_ERROR = 14, 3 / (1 << 7)
#: Size of a quantile sketch, and the error of its ranks at 99 percent confidence.
QUANTILE_K, RANK_ERROR = 800, 0.005


def daily_sketches(df: DataFrame, day: str, key: str, value: str) -> DataFrame:
    """Per day: rows, a distinct and a set sketch of ``key``, and a quantile sketch of ``value``; NULLs are in none."""
    number = F.col(value).cast("double")
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(key, DISTINCT_LG).alias("distinct_sketch"),
        F.theta_sketch_agg(key, SET_LG).alias("set_sketch"),
        F.kll_sketch_agg_double(number, QUANTILE_K).alias("quantile_sketch"),
    )


def merged_distinct(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct keys and the share of rows that are not copies, over the days of each group."""
    found = sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_keys")
    )
    return found.withColumn("uniqueness_pct", F.try_divide(F.col("distinct_keys") * 100.0, F.col("rows")))


def shared_keys(sketches: DataFrame, first: Column, second: Column) -> DataFrame:
    """One row: estimated distinct keys of the days of either condition, and of those that both have."""
    merged = sketches.agg(
        F.theta_union_agg(F.when(first, F.col("set_sketch")), SET_LG).alias("a"),
        F.theta_union_agg(F.when(second, F.col("set_sketch")), SET_LG).alias("b"),
    )
    return merged.select(
        F.theta_sketch_estimate("a").alias("first_keys"),
        F.theta_sketch_estimate("b").alias("second_keys"),
        F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("shared_keys"),
    )


def merged_quantiles(sketches: DataFrame, probabilities: dict[str, float], *by: Column | str) -> DataFrame:
    """Estimated quantiles over the days of each group."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("quantile_sketch").alias("_merged"))
    values = {n: F.kll_sketch_get_quantile_double("_merged", F.lit(float(p))) for n, p in probabilities.items()}
    return merged.withColumns(values).drop("_merged")


def rank_errors(df: DataFrame, estimates: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str]) -> DataFrame:
    """How far each estimate's true rank lies from its probability, per group: 0 where the estimate covers it.

    The groups of ``estimates`` are few; the rows are counted before the shuffle.
    """
    rows = df.where(F.col(value).isNotNull()).join(F.broadcast(estimates), list(by))
    counts = [F.count(F.lit(1)).alias("_n")]
    for name in probabilities:
        counts += [F.count_if(F.col(value) < F.col(name)).alias(f"_below_{name}"), F.count_if(F.col(value) <= F.col(name)).alias(f"_upto_{name}")]
    counted = rows.groupBy(*by).agg(*counts)

    def error(name: str, p: float) -> Column:
        below, upto = (F.col(f"_{side}_{name}") / F.col("_n") for side in ("below", "upto"))
        return F.greatest(below - F.lit(p), F.lit(p) - upto, F.lit(0.0)).alias(name)

    return counted.select(*by, F.col("_n").alias("rows"), *(error(n, p) for n, p in probabilities.items()))

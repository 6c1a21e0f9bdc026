"""Exact quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ordered import cut, join_keys, running_sum


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group; NULLs are ignored and NaN ranks last.

    Copies of a value are counted before the shuffle. The distinct values are cut along (group, value)
    into ranges of equal size, so a task sorts one range whatever the distribution; totals of the
    ranges carry the rank across. Result: groups plus one column per entry of ``probabilities``;
    ``extra`` adds aggregates over the distinct values ``_v``, their frequencies ``_n`` and the group's
    mean ``_mean``.
    """
    groups = list(groups)
    found = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("_v"))
    counts = cut(found.agg(F.count(F.lit(1)).alias("_n")), [*groups, "_v"], name="frequencies")
    placed = running_sum(counts, groups, ["_v"], F.col("_n"), "_upto", "_total", all_sliced=True)
    if extra:
        key = join_keys(counts, groups)
        means = counts.groupBy(*groups).agg((F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("_mean"))
        means = means.select(*(c.alias(n) for n, c in join_keys(means, groups).items()), "_mean")
        placed = placed.withColumns(key).join(means, list(key)).drop(*key)

    def value_at(rank):
        covers = (F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto"))
        return F.max(F.when(covers, F.col("_v")))

    results = []
    for name, p in probabilities.items():
        position = (F.col("_total") - 1) * F.lit(float(p)) + 1
        low, high = value_at(F.floor(position)), value_at(F.ceil(position))
        share = F.max(position - F.floor(position))
        between = low * (F.lit(1.0) - share) + high * share
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    results += [column.alias(name) for name, column in (extra or {}).items()]
    return placed.groupBy(*groups).agg(*results)


def moments() -> dict[str, Column]:
    """Count, mean, sample deviation and extremes from frequencies, for ``extra`` of ``exact_quantiles``."""
    n, squares = F.sum("_n"), F.sum(F.col("_n") * (F.col("_v") - F.col("_mean")) ** 2)
    return {
        "n": n,
        "mean": F.max("_mean"),
        "std": F.sqrt(F.try_divide(squares, n - 1)),
        "min_value": F.min("_v"),
        "max_value": F.max("_v"),
    }

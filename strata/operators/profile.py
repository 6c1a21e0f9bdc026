"""Data profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quantiles import exact_quantiles, moments


def null_fraction(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column, from one aggregate over one scan."""
    columns = list(columns or df.columns)
    shares = [
        F.struct(F.lit(c).alias("column_name"), F.avg(F.col(c).isNull().cast("int")).alias("null_fraction"))
        for c in columns
    ]
    return df.agg(F.array(*shares).alias("_all")).select(F.inline("_all"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct value of each column; NULL counts as a value."""
    texts = df.select(*(F.col(c).cast("string").alias(c) for c in columns))
    return (
        texts.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each numeric column.

    Everything follows from the frequencies of the values, so the table is read once.
    """
    columns = list(columns or numeric_columns(df))
    numbers = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    summary = exact_quantiles(
        numbers.unpivot([], columns, "column_name", "value"),
        ["column_name"],
        "value",
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        extra=moments(),
    )
    named = F.explode(F.array(*map(F.lit, columns))).alias("column_name")
    listed = df.sparkSession.range(1).select(named)  # a column of NULLs has no frequencies but a row
    found = listed.join(summary, "column_name", "left").fillna(0, ["n"])
    return found.select("column_name", "n", "mean", "std", "min_value", "max_value", "p25", "p50", "p75")


def rows_per_day(df: DataFrame, timestamp: str, day: str = "day") -> DataFrame:
    return df.groupBy(F.to_date(timestamp).alias(day)).agg(F.count(F.lit(1)).alias("rows"))


def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values of a column; with ``limit``, the smallest ones."""
    found = df.select(column).distinct()
    return found if limit is None else found.orderBy(column).limit(limit)


def sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, so that two calls show the same rows."""
    return df.orderBy(*order).limit(n)

"""Dimension tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import calendar
from strata.functions.codes import PAYMENT_TYPES
from strata.sources.contracts import contract
from strata.sources.readers import literal_table


def day_spine(bounds: DataFrame, column: str = "day") -> DataFrame:
    """All days between the two dates of a one-row table (first_day, last_day).

    First one row per year, then its days: no list is longer than a year, whatever the range.
    """
    years = bounds.select("*", F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("_year"))
    first = F.greatest("first_day", F.make_date("_year", F.lit(1), F.lit(1)))
    last = F.least("last_day", F.make_date("_year", F.lit(12), F.lit(31)))
    return years.select(F.explode(F.sequence(first, last)).alias(column))


def date_bounds(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def expand_hours(days: DataFrame) -> DataFrame:
    """24 rows per day with calendar parts and day-part flags; ``days`` has one column pickup_date."""
    day, hour = F.col("pickup_date"), F.col("pickup_hour")
    # Every day meets each of the 24 hours: an explode, not a join of two tables.
    return days.select(
        "pickup_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("pickup_hour")
    ).select(
        "pickup_date",
        "pickup_hour",
        F.dayofweek(day).alias("pickup_weekday"),
        calendar.is_weekend(day).alias("is_weekend"),
        calendar.time_bucket(hour).alias("time_bucket"),
        calendar.is_rush_hour(hour).alias("is_rush_hour"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
    )


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return expand_hours(day_spine(bounds, "pickup_date"))


def dim_date_for(df: DataFrame, day: str = "pickup_date") -> DataFrame:
    """Date dimension that covers exactly the days a table spans."""
    return expand_hours(day_spine(date_bounds(df, day), "pickup_date"))


def dim_payment(spark: SparkSession) -> DataFrame:
    schema = contract(payment_type="long", payment_name="string")
    return literal_table(spark, list(PAYMENT_TYPES.items()), schema)


def dim_zone(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup from a headered CSV file, with a typed id."""
    schema = "LocationID int, Borough string, Zone string, service_zone string"
    return spark.read.schema(schema).option("header", "true").csv(path)

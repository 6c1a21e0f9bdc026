"""Calendar parts and day-part labels shared by the date dimension and the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and inclusive hour bounds that published tables already use.
TIME_BUCKETS = (("early_morning", 0, 6), ("morning", 7, 12), ("afternoon", 13, 18))
LAST_BUCKET = "evening"
RUSH_HOURS = ((7, 9), (16, 19))
WEEKEND_DAYS = (1, 7)  # dayofweek counts from Sunday = 1


def time_bucket(hour: Column) -> Column:
    label = F.lit(LAST_BUCKET)
    for name, first, last in reversed(TIME_BUCKETS):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def is_rush_hour(hour: Column) -> Column:
    inside = F.lit(False)
    for first, last in RUSH_HOURS:
        inside = inside | hour.between(first, last)
    return inside


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*WEEKEND_DAYS)


def parse_timestamp(text: Column, *formats: str) -> Column:
    """The time that a text states in the first format that fits; NULL where none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)).cast("timestamp_ntz")

"""Features of a trip, written against the raw column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_seconds(later: str, earlier: str) -> Column:
    """Difference of two timestamps with fractions of a second cut off on both sides."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def add_trip_features(
    df: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
) -> DataFrame:
    """Day, duration, speed and unit prices. Division by zero gives NULL, not an error."""
    return df.withColumns(
        {
            "is_tip_more_total": F.coalesce(F.col("tip_amount") > F.col("total_amount"), F.lit(False)),
            "pickup_date": F.to_date(pickup),
            "trip_duration_min": whole_seconds(dropoff, pickup) / F.lit(60),
        }
    ).withColumns(
        {
            "avg_speed_mph": F.try_divide(F.col("trip_distance") * 60, F.col("trip_duration_min")),
            "fare_per_mile": F.try_divide("total_amount", "trip_distance"),
            "fare_per_min": F.try_divide("total_amount", "trip_duration_min"),
        }
    )

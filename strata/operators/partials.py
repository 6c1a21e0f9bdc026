"""Marts from mergeable daily partials.

A partial holds, per day and key of a mart, counts, sums and sums of squares. Partials of different days
add up, so a late day is recomputed alone and every mart is a small aggregate over what is published. All
partials come from one pass over the fact: one plan with grouping sets, one shuffle, one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import calendar
from strata.operators.marts import distance_band, with_zone

DAY = "pickup_date"
#: Keys of each partial besides the day.
PARTIALS = {
    "hour": ("pickup_hour",),
    "route": ("pulocation_id", "dolocation_id"),
    "payment": ("payment_type",),
    "band": ("distance_band", "time_bucket"),
    "fare": ("fare_amount",),
}


def _measures() -> dict[str, Column]:
    """What is added up: name -> summand; a NULL summand leaves its count as it is."""
    total, tip, minutes = F.col("total_amount"), F.col("tip_amount"), F.col("trip_duration_min")
    return {
        "revenue": total,
        "fare": F.col("_fare"),
        "distance": F.col("trip_distance"),
        "tip": tip,
        "minutes": minutes,
        "tipped": (tip > 0).cast("int"),
        "tip_of_total": F.try_divide(tip, total),
        "tip_of_fare": F.try_divide(tip, F.col("_fare")),
        "speed": F.try_divide(F.col("trip_distance") * 60, minutes),
        "per_minute": F.try_divide(total, minutes),
        "per_mile": F.try_divide(total, F.col("trip_distance")),
    }


def daily_partials(fact: DataFrame) -> DataFrame:
    """One row per day, partial and key: trips, and per measure its count (n_), sum and sum of squares (sq_).

    ``mart`` names the partial; the keys of other partials are NULL in its rows. A NULL key is a key like any other.
    """
    keys = list(dict.fromkeys(key for group in PARTIALS.values() for key in group))
    rows = fact.withColumns(
        {
            "_fare": F.col("fare_amount"),
            "distance_band": distance_band(F.col("trip_distance")),
            "time_bucket": calendar.time_bucket(F.col("pickup_hour")),
        }
    )
    summed = [F.count(F.lit(1)).alias("trips")]
    for name, value in _measures().items():
        value = value.cast("double")
        summed += [F.count(value).alias(f"n_{name}"), F.sum(value).alias(name), F.sum(value * value).alias(f"sq_{name}")]
    mart = F.coalesce(*(F.when(F.grouping(group[0]) == 0, F.lit(name)) for name, group in PARTIALS.items()))
    sets = [[DAY, *group] for group in PARTIALS.values()]
    return rows.groupingSets(sets, DAY, *keys).agg(mart.alias("mart"), *summed)


def merged(partials: DataFrame, mart: str, *by: Column | str) -> DataFrame:
    """A partial's rows added up by some of its keys, the day or what follows from them."""
    sums = [F.sum("trips").alias("trips")]
    for name in _measures():
        sums += [F.sum(f"{p}{name}").alias(f"{p}{name}") for p in ("n_", "", "sq_")]
    return partials.where(F.col("mart") == mart).groupBy(*by).agg(*sums)


def mean(measure: str) -> Column:
    return F.try_divide(F.col(measure), F.col(f"n_{measure}"))


def deviation(measure: str) -> Column:
    """Sample deviation from a count, a sum and a sum of squares; NULL below two values."""
    n = F.col(f"n_{measure}")
    squares = F.col(f"sq_{measure}") - F.try_divide(F.col(measure) * F.col(measure), n)
    return F.sqrt(F.try_divide(F.greatest(squares, F.lit(0.0)), F.when(n > 1, n - 1)))


def daily_summary(partials: DataFrame) -> DataFrame:
    return merged(partials, "hour", DAY).select(
        DAY,
        F.col("trips").alias("total_trips"),
        F.col("revenue").alias("total_revenue"),
        mean("revenue").alias("avg_revenue_per_trip"),
        mean("distance").alias("avg_distance_per_trip"),
        mean("tip").alias("avg_tip"),
        F.col("fare").alias("total_fare"),
    )


def revenue_by_hour(partials: DataFrame) -> DataFrame:
    return merged(partials, "hour", "pickup_hour").select("pickup_hour", "trips", "revenue", mean("revenue").alias("avg_revenue"))


def weekly_revenue(partials: DataFrame) -> DataFrame:
    """Revenue per week with the deviation of single trips, which needs the squares."""
    week = F.trunc(DAY, "week").alias("week")
    return merged(partials, "hour", week).select(
        "week", "trips", "revenue", mean("revenue").alias("avg_revenue"), deviation("revenue").alias("revenue_deviation")
    )


def _split(partials: DataFrame, flag: Column, name: str) -> DataFrame:
    return merged(partials, "hour", flag.alias(name)).select(
        name, "trips", "revenue", mean("revenue").alias("avg_revenue"), mean("minutes").alias("avg_duration_min")
    )


def weekend_split(partials: DataFrame) -> DataFrame:
    return _split(partials, calendar.is_weekend(F.col(DAY)), "is_weekend")


def rush_hour_split(partials: DataFrame) -> DataFrame:
    return _split(partials, calendar.is_rush_hour(F.col("pickup_hour")), "is_rush_hour")


def od_pairs(partials: DataFrame, zones: DataFrame) -> DataFrame:
    pairs = merged(partials, "route", "pulocation_id", "dolocation_id").select(
        "pulocation_id", "dolocation_id", "trips", "revenue", mean("distance").alias("avg_distance")
    )
    return with_zone(with_zone(pairs, zones, "pulocation_id", "pickup"), zones, "dolocation_id", "dropoff")


def revenue_by_location(partials: DataFrame, zones: DataFrame) -> DataFrame:
    totals = merged(partials, "route", "pulocation_id").select(
        "pulocation_id", "trips", "revenue", mean("revenue").alias("avg_revenue")
    )
    return with_zone(totals, zones, "pulocation_id", "pickup")


def zone_traffic(partials: DataFrame) -> DataFrame:
    ends = [
        merged(partials, "route", F.col(zone).alias("zone_id")).select("zone_id", *(F.col("trips").alias(c) if c == mine else F.lit(0).alias(c) for c in ("pickups", "dropoffs")))
        for zone, mine in (("pulocation_id", "pickups"), ("dolocation_id", "dropoffs"))
    ]
    summed = ends[0].unionByName(ends[1]).groupBy("zone_id").agg(*(F.sum(c).alias(c) for c in ("pickups", "dropoffs")))
    return summed.withColumn("total", F.col("pickups") + F.col("dropoffs"))


def tip_behavior(partials: DataFrame) -> DataFrame:
    return merged(partials, "payment", "payment_type").select(
        "payment_type", "trips", mean("tipped").alias("tipped_share"), mean("tip").alias("avg_tip"), mean("tip_of_total").alias("avg_tip_ratio")
    )


def tip_by_band(partials: DataFrame) -> DataFrame:
    return merged(partials, "band", "distance_band", "time_bucket").select(
        "distance_band", "time_bucket", "trips", mean("tip").alias("avg_tip"), mean("tip_of_fare").alias("avg_tip_ratio")
    )


def efficiency(partials: DataFrame) -> DataFrame:
    return merged(partials, "band", "time_bucket").select(
        "time_bucket", "trips", mean("speed").alias("avg_speed_mph"), mean("per_minute").alias("avg_fare_per_min"), mean("per_mile").alias("avg_fare_per_mile")
    )


def fare_by_date(partials: DataFrame) -> DataFrame:
    """Average, extremes and exact median per day, from the day's fare frequencies."""
    return (
        partials.where("mart = 'fare'")
        .groupBy(DAY)
        .agg(
            F.percentile("fare_amount", 0.5, F.col("trips")).alias("median_fare"),
            F.try_divide(F.sum("fare"), F.sum("n_fare")).alias("avg_fare"),
            F.min("fare_amount").alias("min_fare"),
            F.max("fare_amount").alias("max_fare"),
        )
    )

"""Star-schema fact and the marts behind the dashboards.

Every mart takes the fact (or the daily summary) and returns a small aggregate. Sums and
averages are combined before the shuffle, so a day, zone or payment type with a large
share of the trips does not overload a task. Lookups are joined after aggregating, without a hint:
adaptive execution broadcasts a side whose measured bytes allow it and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.config import stored
from strata.functions import calendar
from strata.operators.quantiles import exact_quantiles

# Column names of the published fact table.
FACT_COLUMNS = (
    "trip_id",
    "pickup_date",
    "pickup_hour",
    "pulocation_id",
    "dolocation_id",
    "payment_type",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "tip_amount",
    "trip_duration_min",
)

TREND_LIMIT = 2.0  # standard deviations from the mean number of trips per day
OUTLIER_LIMIT = 1.5  # standard deviations of the residual around the fitted line
DISTANCE_BANDS = ((1.0, "0-1"), (3.0, "1-3"), (10.0, "3-10"))
LAST_BAND = "10+"


def fact_trips(silver: DataFrame) -> DataFrame:
    return silver.withColumn("pickup_hour", F.hour("tpep_pickup_datetime")).select(*FACT_COLUMNS)


def trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def daily_summary(fact: DataFrame) -> DataFrame:
    # Column names of the published daily summary.
    return fact.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("trip_distance").alias("avg_distance_per_trip"),
        F.avg("tip_amount").alias("avg_tip"),
        F.sum("fare_amount").alias("total_fare"),
    )


def kpi_tiles(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("trip_distance").alias("avg_distance_per_trip"),
    )


def kpi_tiles_from_daily(daily: DataFrame) -> DataFrame:
    """The same tiles from the daily summary: averages weighted by the trips of each day."""
    n = F.sum("total_trips")
    return daily.agg(
        n.alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        F.try_divide(F.sum("total_revenue"), n).alias("avg_revenue_per_trip"),
        F.try_divide(F.sum(F.col("avg_distance_per_trip") * F.col("total_trips")), n).alias(
            "avg_distance_per_trip"
        ),
    )


def with_date(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact with calendar columns; the date dimension has one row per day *and* hour."""
    return fact.join(dates, ["pickup_date", "pickup_hour"])


def with_payment(fact: DataFrame, payments: DataFrame) -> DataFrame:
    return fact.join(payments, "payment_type", "left")


def with_zone(df: DataFrame, zones: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """Zone attributes for one of the two zone roles; unknown ids keep NULL attributes."""
    named = zones.select(
        F.col("LocationID").cast("int").alias(id_column),
        F.col("Borough").alias(f"{prefix}_borough"),
        F.col("Zone").alias(f"{prefix}_zone"),
    )
    return df.join(named, id_column, "left")


def sliced(
    fact: DataFrame,
    dates: DataFrame,
    first_day: int,
    last_day: int,
    payment_types: list[int],
    buckets: list[str],
) -> DataFrame:
    """Dashboard slicers: days of the month, payment types and day parts.

    The calendar slicers filter the dimension before the join. Where the fact is a table partitioned by day, the
    days that are left prune its directories while the query runs (``published_fact``); a fact that is computed
    from raw rows is filtered by the join alone.
    """
    wanted = dates.where(
        F.col("day_of_month").between(first_day, last_day) & F.col("time_bucket").isin(buckets)
    )
    return with_date(fact.where(F.col("payment_type").isin(payment_types)), wanted)


def kpi_cube(fact: DataFrame, slicers: Sequence[str]) -> DataFrame:
    """The tiles for every combination of slicers and all totals, from one pass over the fact.

    ``totals`` has a bit per slicer, the last one lowest, that is set where the row is a total over it. It tells the
    total from the trips whose slicer is NULL.
    """
    return fact.cube(*slicers).agg(
        F.grouping_id().alias("totals"),
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.avg("trip_distance").alias("avg_distance_per_trip"),
    )


def heatmap(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.dayofweek("pickup_date").alias("pickup_weekday"), "pickup_hour").agg(trips())


def heatmap_matrix(fact: DataFrame) -> DataFrame:
    """The heatmap with one column per hour; the 24 hours are listed, so no extra pass finds them."""
    return (
        heatmap(fact).groupBy("pickup_weekday").pivot("pickup_hour", list(range(24))).agg(F.first("trips"))
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    """Trips per day with the z-score over all days; the window sees one row per day."""
    everything = Window.partitionBy()
    n = F.col("total_trips")
    z = F.try_divide(n - F.avg(n).over(everything), F.stddev_samp(n).over(everything))
    return daily.select("pickup_date", "total_trips", z.alias("z")).withColumn(
        "flagged", F.coalesce(F.abs("z") > TREND_LIMIT, F.lit(False))
    )


def top_zones(fact: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    best = (
        fact.groupBy("pulocation_id")
        .agg(trips())
        .orderBy(F.col("trips").desc(), F.col("pulocation_id").asc())
        .limit(n)
    )
    return with_zone(best, zones, "pulocation_id", "pickup")


def distance_fare(fact: DataFrame) -> DataFrame:
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    return fact.agg(
        trips(),
        F.corr(fare, distance).alias("corr"),
        F.regr_slope(fare, distance).alias("slope"),
        F.regr_intercept(fare, distance).alias("intercept"),
    )


def fare_outliers(fact: DataFrame, limit: float = OUTLIER_LIMIT) -> DataFrame:
    """Trips whose fare is far from the fitted line of fare over distance.

    Slope, intercept and the residual's deviation all follow from one aggregate: the sum of
    squared residuals of a least-squares line is syy - sxy^2 / sxx. The fit and the trips read one
    written copy of the three columns, so the fact is computed once.
    """
    fact = stored(fact.select("trip_id", "trip_distance", "fare_amount"), "fares")
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    fit = fact.agg(
        F.regr_slope(fare, distance).alias("slope"),
        F.regr_intercept(fare, distance).alias("intercept"),
        F.sqrt(
            F.greatest(
                F.regr_syy(fare, distance)
                - F.try_divide(F.pow(F.regr_sxy(fare, distance), F.lit(2)), F.regr_sxx(fare, distance)),
                F.lit(0.0),
            )
            / (F.regr_count(fare, distance) - 1)
        ).alias("spread"),
    )
    line = fit.select(F.struct("slope", "intercept", "spread").alias("line")).scalar()
    residual = fare - (line["slope"] * distance + line["intercept"])
    return fact.withColumn("residual", residual).where(F.abs("residual") > line["spread"] * F.lit(limit))


def binned_distance_fare(fact: DataFrame, width: float = 1.0) -> DataFrame:
    """Scatter data at a fixed resolution: trips per distance bin and fare bin."""
    return fact.groupBy(
        F.floor(F.col("trip_distance") / width).alias("distance_bin"),
        F.floor(F.col("fare_amount") / width).alias("fare_bin"),
    ).agg(trips())


def payment_share(fact: DataFrame, payments: DataFrame) -> DataFrame:
    counts = fact.groupBy("payment_type").agg(trips())
    share = F.col("trips") * 100.0 / F.sum("trips").over(Window.partitionBy())
    return with_payment(counts.withColumn("share_pct", share), payments)


def _split(fact: DataFrame, flag: Column, name: str) -> DataFrame:
    return fact.groupBy(flag.alias(name)).agg(
        trips(),
        F.sum("total_amount").alias("revenue"),
        F.avg("total_amount").alias("avg_revenue"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
    )


def weekend_split(fact: DataFrame) -> DataFrame:
    return _split(fact, calendar.is_weekend(F.col("pickup_date")), "is_weekend")


def rush_hour_split(fact: DataFrame) -> DataFrame:
    return _split(fact, calendar.is_rush_hour(F.col("pickup_hour")), "is_rush_hour")


def distance_band(distance: Column) -> Column:
    label = F.lit(LAST_BAND)
    for below, name in reversed(DISTANCE_BANDS):
        label = F.when(distance < below, name).otherwise(label)
    return label


def tip_by_band(fact: DataFrame) -> DataFrame:
    return fact.groupBy(
        distance_band(F.col("trip_distance")).alias("distance_band"),
        calendar.time_bucket(F.col("pickup_hour")).alias("time_bucket"),
    ).agg(
        trips(),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg(F.try_divide("tip_amount", "fare_amount")).alias("avg_tip_ratio"),
    )


def tip_behavior(fact: DataFrame) -> DataFrame:
    return fact.groupBy("payment_type").agg(
        trips(),
        F.avg((F.col("tip_amount") > 0).cast("int")).alias("tipped_share"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg(F.try_divide("tip_amount", "total_amount")).alias("avg_tip_ratio"),
    )


def od_pairs(fact: DataFrame, zones: DataFrame) -> DataFrame:
    pairs = fact.groupBy("pulocation_id", "dolocation_id").agg(
        trips(), F.sum("total_amount").alias("revenue"), F.avg("trip_distance").alias("avg_distance")
    )
    return with_zone(with_zone(pairs, zones, "pulocation_id", "pickup"), zones, "dolocation_id", "dropoff")


def revenue_by_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pickup_hour").agg(
        trips(), F.sum("total_amount").alias("revenue"), F.avg("total_amount").alias("avg_revenue")
    )


def revenue_by_location(fact: DataFrame, zones: DataFrame) -> DataFrame:
    totals = fact.groupBy("pulocation_id").agg(
        trips(), F.sum("total_amount").alias("revenue"), F.avg("total_amount").alias("avg_revenue")
    )
    return with_zone(totals, zones, "pulocation_id", "pickup")


def fare_by_date(fact: DataFrame) -> DataFrame:
    """Average, extremes and exact median fare per day, all from the fare frequencies of the day."""
    return exact_quantiles(
        fact,
        ["pickup_date"],
        "fare_amount",
        {"median_fare": 0.5},
        extra={
            "avg_fare": F.sum(F.col("_v") * F.col("_n")) / F.sum("_n"),
            "min_fare": F.min("_v"),
            "max_fare": F.max("_v"),
        },
    )


def efficiency(trips_with_speed: DataFrame) -> DataFrame:
    """Speed and unit prices per day part; trips of zero duration have none and are ignored."""
    return trips_with_speed.groupBy(
        calendar.time_bucket(F.hour("tpep_pickup_datetime")).alias("time_bucket")
    ).agg(
        trips(),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.avg("fare_per_min").alias("avg_fare_per_min"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
    )


def zone_traffic(fact: DataFrame) -> DataFrame:
    """Trips that start and trips that end in each zone, from one pass over the fact."""
    ends = F.array(
        F.struct(F.col("pulocation_id").alias("zone_id"), F.lit(1).alias("pickups"), F.lit(0).alias("dropoffs")),
        F.struct(F.col("dolocation_id").alias("zone_id"), F.lit(0).alias("pickups"), F.lit(1).alias("dropoffs")),
    )
    return (
        fact.select(F.inline(ends))
        .groupBy("zone_id")
        .agg(F.sum("pickups").alias("pickups"), F.sum("dropoffs").alias("dropoffs"))
        .withColumn("total", F.col("pickups") + F.col("dropoffs"))
    )

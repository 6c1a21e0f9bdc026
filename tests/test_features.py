from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.config import DateRange
from strata.functions import calendar, codes
from strata.functions.features import add_trip_features
from strata.functions.keys import with_key
from strata.operators import dims
from tests.conftest import rows_of

KEY = ["vendor", "pickup", "dropoff", "pu", "do", "fare"]


def test_key_is_deterministic_and_distinguishes_rows(spark):
    rows = [
        (6, "2023-07-14 23:58:01", "2023-07-15 00:41:59", 17, 263, 33.25),
        (6, "2023-07-14 23:58:01", "2023-07-15 00:41:59", 263, 17, 33.25),
        (6, "2023-07-14 23:58:01", "2023-07-15 00:41:59", 17, 263, 33.25),
    ]
    texts = spark.createDataFrame(rows, "vendor bigint, pickup string, dropoff string, pu bigint, do bigint, fare double")
    df = texts.withColumns({"pickup": F.to_timestamp("pickup"), "dropoff": F.to_timestamp("dropoff")})
    first, second, third = [r.trip_id for r in with_key(df, KEY, "trip_id").collect()]
    assert first == third != second
    assert len(first) == 32


def test_null_position_matters_unless_nulls_are_skipped(spark):
    df = spark.createDataFrame([(1, None, 2), (1, 2, None)], "a int, b int, c int")
    empty = [r.k for r in with_key(df, ["a", "b", "c"], "k").collect()]
    skipped = [r.k for r in with_key(df, ["a", "b", "c"], "k", nulls="skip").collect()]
    assert empty[0] != empty[1] and skipped[0] == skipped[1]
    with pytest.raises(ValueError):
        with_key(df, ["a"], "k", nulls="drop")


def test_negative_zero_has_the_key_of_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert len({r.k for r in with_key(df, ["x"], "k").collect()}) == 1


def test_features_of_a_trip_without_duration(spark):
    when = dt.datetime(2024, 1, 6, 10)
    rows = [(when, when, 2.0, 10.0, 20.0), (when, when + dt.timedelta(minutes=30, microseconds=9), 2.0, 10.0, 1.0)]
    schema = (
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double,"
        " total_amount double, tip_amount double"
    )
    zero, normal = add_trip_features(spark.createDataFrame(rows, schema)).collect()
    assert (zero.trip_duration_min, zero.avg_speed_mph, zero.fare_per_min, zero.fare_per_mile) == (0.0, None, None, 5.0)
    assert zero.is_tip_more_total and not normal.is_tip_more_total
    assert (normal.trip_duration_min, normal.avg_speed_mph) == (30.0, 4.0)
    assert normal.pickup_date == dt.date(2024, 1, 6)


@pytest.mark.parametrize(
    "hour, bucket, rush",
    [
        (0, "early_morning", False),
        (6, "early_morning", False),
        (7, "morning", True),
        (9, "morning", True),
        (10, "morning", False),
        (12, "morning", False),
        (13, "afternoon", False),
        (16, "afternoon", True),
        (18, "afternoon", True),
        (19, "evening", True),
        (20, "evening", False),
        (23, "evening", False),
    ],
)
def test_day_parts(spark, hour, bucket, rush):
    h = F.lit(hour)
    row = spark.range(1).select(calendar.time_bucket(h).alias("b"), calendar.is_rush_hour(h).alias("r")).first()
    assert (row.b, row.r) == (bucket, rush)


def test_dim_date_has_24_rows_per_day(spark):
    table = dims.dim_date(spark, dt.date(2023, 12, 30), dt.date(2024, 1, 1))
    assert table.count() == 72
    assert table.columns == [
        "pickup_date", "pickup_hour", "pickup_weekday", "is_weekend", "time_bucket",
        "is_rush_hour", "day_of_month", "month", "year", "quarter",
    ]
    days = table.where("pickup_hour = 0").select("pickup_weekday", "is_weekend", "quarter", "year")
    assert rows_of(days) == [(1, True, 4, 2023), (2, False, 1, 2024), (7, True, 4, 2023)]


def test_dim_zone_reads_typed_ids(spark, folder):
    path = folder("zones")
    spark.createDataFrame([("1", "A", "Here", "X"), ("2", "B", "There, far", "Y")],
                          "LocationID string, Borough string, Zone string, service_zone string") \
        .coalesce(1).write.option("header", "true").csv(path)
    zones = dims.dim_zone(spark, path)
    assert zones.schema["LocationID"].dataType.typeName() == "integer"
    assert rows_of(zones) == [(1, "A", "Here", "X"), (2, "B", "There, far", "Y")]


def test_dim_payment(spark):
    assert rows_of(dims.dim_payment(spark))[0] == (0, "Flex Fare trip")
    assert dims.dim_payment(spark).count() == 7


def test_decode_falls_back(spark):
    df = spark.createDataFrame([(1.0,), (99.0,), (8.0,), (None,)], "c double")
    found = [r[0] for r in df.select(codes.decode(F.col("c"), codes.RATE_CODES, "?")).collect()]
    assert found == ["Standard rate", "Null/unknown", "?", "?"]


def test_date_range():
    assert DateRange.of("2024-01-05").is_single_day
    assert DateRange.of("2024-01-05", "2024-01-07").n_days == 3
    assert DateRange.of("2024-01-05", "2024-01-07").label == "20240105_20240107"
    with pytest.raises(ValueError):
        DateRange.of("2024-01-05", "2024-01-04")
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        DateRange.of("05.01.2024")


def test_day_spine_is_inclusive(spark):
    assert len(rows_of(DateRange.of("2024-02-28", "2024-03-01").spine(spark))) == 3

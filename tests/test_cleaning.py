from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.rules import Rule
from strata.operators.clean import apply_rules, reject_report, rejected, violations
from strata.plans.trips import RULES, raw_trips
from strata.sources.contracts import RAW_TRIP
from tests.conftest import SMALL, rows_of

GOOD = dict(
    VendorID=1,
    tpep_pickup_datetime=dt.datetime(2024, 1, 5, 10),
    tpep_dropoff_datetime=dt.datetime(2024, 1, 5, 10, 30),
    passenger_count=1.0,
    trip_distance=2.5,
    RatecodeID=1.0,
    store_and_fwd_flag="N",
    PULocationID=10,
    DOLocationID=20,
    payment_type=1,
    fare_amount=12.0,
    extra=0.0,
    mta_tax=0.5,
    tip_amount=0.0,
    tolls_amount=0.0,
    improvement_surcharge=1.0,
    total_amount=15.0,
    congestion_surcharge=0.0,
    Airport_fee=0.0,
)

BAD = [
    ("tpep_pickup_datetime", None, 0),
    ("tpep_dropoff_datetime", None, 0),
    ("VendorID", 3, 1),
    ("VendorID", None, 1),
    ("RatecodeID", 7.0, 2),
    ("RatecodeID", None, 2),
    ("payment_type", 7, 3),
    ("payment_type", -1, 3),
    ("fare_amount", 0.0, 4),
    ("fare_amount", -0.0, 4),
    ("mta_tax", 0.0, 5),
    ("mta_tax", None, 5),
    ("improvement_surcharge", -1.0, 6),
    ("total_amount", 0.0, 7),
    ("trip_distance", 0.0, 8),
    ("passenger_count", 0.0, 9),
    ("passenger_count", None, 9),
    ("extra", -0.5, 10),
    ("tip_amount", -0.01, 11),
    ("tolls_amount", -1.0, 12),
    ("tolls_amount", None, 12),
    ("congestion_surcharge", -2.5, 13),
    ("Airport_fee", None, 14),
    ("tpep_dropoff_datetime", dt.datetime(2024, 1, 5, 9, 59), 15),
]
FINE = [
    ("tpep_dropoff_datetime", dt.datetime(2024, 1, 5, 10)),
    ("tip_amount", -0.0),
    ("RatecodeID", 99.0),
    ("VendorID", 7),
    ("payment_type", 0),
    ("store_and_fwd_flag", None),
    ("PULocationID", None),
]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_TRIP.names) for r in rows], RAW_TRIP)


def test_each_bad_value_is_rejected_for_its_rule(spark):
    df = frame(spark, [{**GOOD, column: value} for column, value, _ in BAD]).withColumn(
        "n", F.monotonically_increasing_id()
    )
    assert apply_rules(df, RULES).count() == 0
    reasons = [r.reason for r in rejected(df, RULES).orderBy("n").collect()]
    assert reasons == [RULES[i].name for _, _, i in BAD]


def test_boundary_values_pass(spark):
    df = frame(spark, [GOOD, *({**GOOD, column: value} for column, value in FINE)])
    assert apply_rules(df, RULES).count() == 1 + len(FINE)
    assert rejected(df, RULES).count() == 0


def test_clean_and_rejected_make_up_the_input(spark):
    raw = raw_trips(spark, SMALL)
    both = apply_rules(raw, RULES).unionAll(rejected(raw, RULES).drop("reason"))
    assert rows_of(both) == rows_of(raw)


def test_reject_report_counts_every_rule(spark):
    rows = [GOOD, {**GOOD, "VendorID": 3, "fare_amount": 0.0}, {**GOOD, "fare_amount": None}]
    report = {r.rule: (r.failing, r.first_failing) for r in reject_report(frame(spark, rows), RULES).collect()}
    assert len(report) == len(RULES)
    assert report["VendorID_known"] == (1, 1)
    assert report["fare_amount_positive"] == (2, 1)
    assert report["extra_non_negative"] == (0, 0)


def test_violations_count_matches_only(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    found = violations(df, [Rule("negative", "x < 0"), Rule("huge", "x > 100")])
    assert rows_of(found) == [("huge", 0), ("negative", 1)]


@pytest.mark.parametrize("missing", ["VendorID", "Airport_fee"])
def test_contract_names_a_missing_column(spark, missing):
    from strata.sources.contracts import require_contract, schema_difference

    df = frame(spark, [GOOD]).drop(missing).withColumn("extra", F.lit("text"))
    names = {d.column: (d.expected, d.found) for d in schema_difference(df, RAW_TRIP)}
    assert names[missing][1] is None and names["extra"] == ("double", "string")
    with pytest.raises(ValueError, match=missing):
        require_contract(df, RAW_TRIP)


def test_contract_drops_unexpected_columns(spark):
    from strata.sources.contracts import require_contract

    df = frame(spark, [GOOD]).withColumn("surplus", F.lit(1))
    assert require_contract(df, RAW_TRIP).columns == RAW_TRIP.names

"""The taxi-trip dataset: its description, and trips derived from the ``lineitem`` table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import DatasetSpec, shared_dir
from strata.functions.features import add_trip_features
from strata.functions.keys import with_key
from strata.functions.rules import Rule, member, non_negative, not_null, ordered, positive
from strata.operators.clean import apply_rules, rename_columns
from strata.operators.dedup import dedup_latest, distinct_on_key
from strata.operators.marts import FACT_COLUMNS, fact_trips
from strata.sources.contracts import RAW_TRIP
from strata.sources.files import path_exists
from strata.sources.readers import read_contract

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# Accepted codes, amounts to check, key columns and column names of published tables.
RULES = (
    not_null(PICKUP, DROPOFF),
    member("VendorID", (1, 2, 6, 7)),
    member("RatecodeID", (1, 2, 3, 4, 5, 6, 99)),
    member("payment_type", (0, 1, 2, 3, 4, 5, 6)),
    positive("fare_amount"),
    positive("mta_tax"),
    positive("improvement_surcharge"),
    positive("total_amount"),
    positive("trip_distance"),
    positive("passenger_count"),
    non_negative("extra"),
    non_negative("tip_amount"),
    non_negative("tolls_amount"),
    non_negative("congestion_surcharge"),
    non_negative("Airport_fee"),
    ordered(PICKUP, DROPOFF),
)
KEY_COLUMNS = (
    "VendorID",
    PICKUP,
    DROPOFF,
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
)
LEGACY_KEY_COLUMNS = ("VendorID", PICKUP, DROPOFF, "PULocationID", "DOLocationID", "fare_amount")
RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pulocation_id",
    "DOLocationID": "dolocation_id",
    "Airport_fee": "airport_fee",
}
TIE_BREAK = (
    "ratecode_id",
    "store_and_fwd_flag",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
AMOUNTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
)
# What profiling looks for: here a predicate describes bad rows.
RANGE_CHECKS = (
    Rule("pickup_before_2024", f"{PICKUP} < TIMESTAMP_NTZ'2024-01-01 00:00:00'"),
    *(Rule(f"negative_{c}", f"{c} < 0") for c in AMOUNTS),
    Rule("dropoff_before_pickup", f"{DROPOFF} < {PICKUP}"),
    Rule("zero_distance", "trip_distance = 0"),
    Rule("negative_distance", "trip_distance < 0"),
    Rule("negative_passengers", "passenger_count < 0"),
    Rule("tip_above_total", "tip_amount > total_amount"),
)

TAXI = DatasetSpec(
    event_time=PICKUP,
    key_columns=KEY_COLUMNS,
    key_name="trip_id",
    rules=RULES,
    renames=RENAMES,
    tie_break=TIE_BREAK,
    landing_from=dt.date(2024, 1, 1),
    gold_columns=FACT_COLUMNS,
)

_TRIPS = """
WITH b AS (
  SELECT CAST(l_orderkey * 7 + l_linenumber AS BIGINT) AS h, l_partkey, l_suppkey FROM {lineitem}
), t AS (
  SELECT h, l_partkey, l_suppkey,
    CASE WHEN h % 10 = 0 THEN 6 WHEN h % 10 = 1 THEN 7 WHEN h % 10 = 2 THEN 3 ELSE 1 + h % 2 END AS vendor,
    TIMESTAMP_NTZ'2023-12-31 00:00:00' + make_dt_interval(0, 0, 0, (h * 7919) % (32 * 86400)) AS pu,
    CASE WHEN h % 37 = 0 THEN -300 WHEN h % 61 = 0 THEN 0 ELSE (h % 61) * 60 + h % 60 END AS dur
  FROM b
)
SELECT CAST(vendor AS INT) AS VendorID,
  pu AS tpep_pickup_datetime,
  CASE WHEN h % 101 = 0 THEN NULL ELSE pu + make_dt_interval(0, 0, 0, dur) END AS tpep_dropoff_datetime,
  CASE WHEN h % 97 = 0 THEN NULL ELSE CAST(h % 7 AS DOUBLE) END AS passenger_count,
  CAST(h % 250 AS DOUBLE) / 10 AS trip_distance,
  CAST(CASE WHEN h % 29 = 0 THEN 99 WHEN h % 31 = 0 THEN 8 ELSE 1 + h % 6 END AS DOUBLE) AS RatecodeID,
  CASE WHEN h % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(1 + h % 265 AS INT) AS PULocationID,
  CAST(1 + (h * 31) % 265 AS INT) AS DOLocationID,
  CAST(CASE WHEN h % 83 = 0 THEN 9 ELSE (h % 11) % 7 END AS BIGINT) AS payment_type,
  CASE WHEN h % 53 = 0 THEN CAST(-5 AS DOUBLE) ELSE CAST(30 + h % 400 AS DOUBLE) / 10 END AS fare_amount,
  CAST(l_suppkey % 4 AS DOUBLE) / 2 AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CASE WHEN h % 211 = 0 THEN CAST(500 AS DOUBLE) ELSE CAST(h % 150 AS DOUBLE) / 10 END AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(1 AS DOUBLE) AS improvement_surcharge,
  CAST(30 + h % 400 + h % 150 + 15 AS DOUBLE) / 10 AS total_amount,
  CASE WHEN l_partkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
  CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS Airport_fee
FROM t
"""

_ZONES = """
SELECT CAST(z.id AS INT) AS LocationID, r.r_name AS Borough, concat('ZONE_', CAST(z.id % 260 AS INT)) AS Zone,
  CASE WHEN z.id IN (132, 138) THEN 'Airports' WHEN z.id % 4 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM (SELECT explode(sequence(1, 263)) AS id) z JOIN {region} r ON r.r_regionkey = z.id % 5
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RAW_TABLES: dict[tuple[str, str], str] = {}


def derive_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_TRIPS, lineitem=table(spark, sf_dir, "lineitem"))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trip table, derived from all of ``lineitem`` and written once per session.

    Raw trips arrive as Parquet files, so queries should scan such files: filters and column
    pruning then reach the scan. Over the derivation itself they would instead repeat its
    arithmetic in every predicate.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    path = _RAW_TABLES.get(known)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = shared_dir(spark, "raw-trips")
        # Written where it is derived: a shuffle of whole rows would cost more than all that most queries do.
        derive_trips(spark, sf_dir).write.parquet(path)
        _RAW_TABLES[known] = path
    return read_contract(spark, path, RAW_TRIP)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ZONES, region=table(spark, sf_dir, "region"))


def clean_trips(raw: DataFrame, spec: DatasetSpec = TAXI) -> DataFrame:
    """Accepted rows with key and features, under their published names."""
    return add_trip_features(_keyed(raw, spec))


#: Types whose text tells any two values apart, so that rows equal in such columns are those with equal keys.
_EXACT_TEXT = ("boolean", "byte", "short", "integer", "long", "double", "date", "timestamp_ntz")


def silver_trips(raw: DataFrame, spec: DatasetSpec = TAXI, gathered_by: str | None = None) -> DataFrame:
    """Clean trips, one row per key. Features come last, so they are neither shuffled nor sorted.

    Nor is the key, where its columns tell the rows apart as it does. With ``gathered_by`` the rows are gathered by
    that day of their event time, for a table with such partitions, before key and features are added.
    """
    accepted, names = apply_rules(raw, spec.rules), [spec.renames.get(c, c) for c in spec.key_columns]
    late_key = all(raw.schema[c].dataType.typeName() in _EXACT_TEXT for c in spec.key_columns)
    if late_key:
        rows = dedup_latest(rename_columns(accepted, spec.renames), names, spec.order, spec.tie_break)
    else:
        rows = dedup_latest(_keyed(raw, spec), [spec.key_name], spec.order, spec.tie_break)
    columns = [c for c in rows.columns if c != spec.key_name]
    if gathered_by is not None:
        rows = rows.withColumn(gathered_by, F.to_date(spec.event_time)).hint("rebalance", gathered_by)
    if late_key:
        rows = with_key(rows, names, spec.key_name)
    return add_trip_features(rows.select(*columns, spec.key_name))


def _keyed(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    accepted = apply_rules(raw, spec.rules)
    return rename_columns(with_key(accepted, spec.key_columns, spec.key_name), spec.renames)


def trip_facts(raw: DataFrame, spec: DatasetSpec = TAXI) -> DataFrame:
    """The fact table straight from raw rows.

    All fact columns are key columns or follow from them, so the copies of a trip need no
    ranking; distinct keys are enough, and each surviving key is hashed once.
    """
    return fact_trips(_distinct_trips(raw, spec))


def timed_trips(raw: DataFrame, spec: DatasetSpec = TAXI) -> DataFrame:
    """Deduplicated trips with all features that follow from the key columns."""
    return _distinct_trips(raw, spec)


def _distinct_trips(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    keys = distinct_on_key(apply_rules(raw, spec.rules), spec.key_columns)
    return rename_columns(add_trip_features(with_key(keys, spec.key_columns, spec.key_name)), spec.renames)

"""Declared schemas and their comparison with what was read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

def contract(**columns: str) -> T.StructType:
    """Schema from ``name="integer"`` pairs; unlike a DDL string it needs no running session."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


# Column names and types of the raw yellow-taxi trip files.
RAW_TRIP = contract(
    VendorID="integer",
    tpep_pickup_datetime="timestamp_ntz",
    tpep_dropoff_datetime="timestamp_ntz",
    passenger_count="double",
    trip_distance="double",
    RatecodeID="double",
    store_and_fwd_flag="string",
    PULocationID="integer",
    DOLocationID="integer",
    payment_type="long",
    fare_amount="double",
    extra="double",
    mta_tax="double",
    tip_amount="double",
    tolls_amount="double",
    improvement_surcharge="double",
    total_amount="double",
    congestion_surcharge="double",
    Airport_fee="double",
)
SAMPLES = contract(
    event_id="long", ts="timestamp_ntz", user_id="long", event_type="string", value="double", props="string"
)


class SchemaDifference(NamedTuple):
    column: str
    expected: str | None
    found: str | None


def schema_difference(df: DataFrame, expected_schema: T.StructType) -> list[SchemaDifference]:
    """Columns that are missing, unexpected or of another type; empty when the contract holds."""
    expected = {f.name: f.dataType.simpleString() for f in expected_schema.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*expected, *(n for n in found if n not in expected)]
    return [
        SchemaDifference(n, expected.get(n), found.get(n)) for n in names if expected.get(n) != found.get(n)
    ]


def require_contract(df: DataFrame, expected_schema: T.StructType) -> DataFrame:
    """``df`` reduced to the contract's columns; raises when one is missing or mistyped."""
    broken = [d for d in schema_difference(df, expected_schema) if d.expected is not None]
    if broken:
        raise ValueError(f"schema contract broken: {broken}")
    return df.select(*expected_schema.names)

"""Silver as a stream: rules, keys and features, one row per key, and attributes of a static lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import DatasetSpec
from strata.functions.features import add_trip_features
from strata.functions.keys import with_key
from strata.operators.clean import apply_rules, rename_columns
from strata.operators.marts import with_zone


def silver_stream(stream: DataFrame, spec: DatasetSpec, lateness: str) -> DataFrame:
    """Accepted rows, the first of each key; a copy that comes within ``lateness`` of event time goes.

    State holds the keys of the last ``lateness`` only. All columns of the key, and what follows from them, are those of
    the batch; of columns that differ between copies the first copy's stay.
    """
    keyed = with_key(apply_rules(stream, spec.rules), spec.key_columns, spec.key_name)
    seen = keyed.withColumn("_seen", F.col(spec.event_time).cast("timestamp")).withWatermark("_seen", lateness)
    once = seen.dropDuplicatesWithinWatermark([spec.key_name]).drop("_seen")
    return add_trip_features(rename_columns(once, spec.renames))


def with_pickup_zone(stream: DataFrame, zones: DataFrame) -> DataFrame:
    """Attributes of the pickup zone from a static table, which is read anew with every batch."""
    return with_zone(stream, zones, "pulocation_id", "pickup")

"""Keyed upsert as a DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from the source, plus all source rows.

    Precondition: keys are unique in ``source`` (see ``dedup_latest``); as in a merge
    statement a second source row for one key would be ambiguous. A NULL key never
    matches, so such rows are kept on both sides.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=False)


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; rows with a NULL in the key never match and do not count."""
    return (
        source.select(*keys)
        .dropna()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )

"""Deduplication by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.config import stored


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: newest by ``order``, ties settled by ``tie_break`` ascending, NULLs last.

    Spark evaluates ``row_number() = 1`` as a group limit before the shuffle too, so a
    map task sends at most one row per key. A key that holds a third of all rows
    therefore costs no more in the reducer than any other key.
    """
    ranking = [F.col(c).desc_nulls_last() for c in order] + [F.col(c).asc_nulls_last() for c in tie_break]
    if not ranking:
        raise ValueError("dedup_latest needs an order or a tie break")
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def distinct_on_key(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """The key columns of a deduplicated table, without choosing survivors.

    When a result needs only columns that make up the key (or are computed from them),
    every copy of a key gives the same answer, so a hash aggregate over the key columns
    replaces hashing, sorting and ranking whole rows.
    """
    return df.select(*key_columns).distinct()


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: total rows, distinct rows and surplus copies, comparing all columns.

    Rows are counted by a hash first, so a task holds one number per row instead of the row. A hash that occurs once
    stands for a row without copies; only the rows of the other hashes are compared as a whole.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    per_hash = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_copies"))
    # Written, so that a short list is broadcast and the rows it rules out are not shuffled.
    repeated = stored(per_hash.where("_copies > 1"), "repeated-hashes")
    several = hashed.join(repeated.select("_hash"), "_hash", "left_semi")
    compared = several.groupBy("_hash", *df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    # All rows but those of repeated hashes are single.
    rows, others = df.agg(F.count(F.lit(1)).alias("_rows")), repeated.agg((-F.coalesce(F.sum("_copies"), F.lit(0))).alias("_rows"))
    single = rows.unionByName(others).select(F.lit(1).cast("long").alias("_copies"), "_rows")
    counts = compared.select("_copies", F.lit(1).cast("long").alias("_rows")).unionByName(single)
    return counts.agg(
        F.sum(F.col("_copies") * F.col("_rows")).alias("total_rows"),
        F.sum("_rows").alias("distinct_rows"),
        F.sum((F.col("_copies") - 1) * F.col("_rows")).alias("duplicate_rows"),
    )

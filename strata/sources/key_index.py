"""Which partitions may hold a key, without reading them.

Beside a table lies an index: the 64-bit hash of every key with the partition it stands in, sorted, with a Bloom
filter per row group. It is a small part of the table's bytes, and a lookup reads one of its columns. Each
partition's entries carry a stamp of the data files they were made from. Where that differs from the files there are
now, the entries count for nothing and the partition has to be searched: an index that was not kept up
costs time, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import file_inventory, path_exists
from strata.sources.readers import in_partitions

HASH, STAMP = "_key_hash", "_files"


def _stamps(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """A digest of the names and sizes of each partition's data files, from the listing alone."""
    name = F.concat_ws(":", F.regexp_extract("path", "[^/]*$", 0), "length")
    return file_inventory(spark, path).groupBy(partition).agg(F.md5(F.concat_ws(",", F.sort_array(F.collect_list(name)))).alias(STAMP))


def index_keys(
    spark: SparkSession, path: str, index_path: str, keys: Sequence[str], partition: str, touched: DataFrame | None = None
) -> None:
    """Write the entries of all partitions, or of those that ``touched`` names in its only column."""
    table = spark.read.parquet(path)
    stamps = _stamps(spark, path, partition)
    if touched is not None:
        table, stamps = in_partitions(table, partition, touched), in_partitions(stamps, partition, touched)
    stamps = stamps.withColumnRenamed(partition, "_partition")
    entries = table.select(partition, F.xxhash64(*keys).alias(HASH)).distinct()
    stamped = entries.join(F.broadcast(stamps), F.col(partition).eqNullSafe(F.col("_partition"))).drop("_partition")
    (
        stamped.repartitionByRange(partition, HASH)
        .sortWithinPartitions(partition, HASH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .partitionBy(partition)
        .parquet(index_path)
    )


def may_hold(spark: SparkSession, path: str, index_path: str, source: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Partitions (one column) of the table that may hold a key of ``source``: by the index, or for want of one."""
    stamps = _stamps(spark, path, partition)
    if not path_exists(spark, index_path):
        return stamps.select(partition)
    index = spark.read.parquet(index_path)
    found = index.join(source.select(F.xxhash64(*keys).alias(HASH)).distinct(), HASH, "left_semi").select(partition)
    known = index.select(F.col(partition).alias("_partition"), STAMP).distinct()
    same = F.col(partition).eqNullSafe(F.col("_partition")) & (stamps[STAMP] == known[STAMP])
    return found.union(stamps.join(known, same, "left_anti").select(partition)).distinct()

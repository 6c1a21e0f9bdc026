"""Writing partitioned tables.

All writers replace whole partitions and can be repeated after a failure: a second run first puts back
what the first one had set aside and then writes the same partitions again. A staged copy is removed once
it is in place; after a failure it stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import DateRange, beside, shared_dir, stored
from strata.operators.upsert import repeated_keys, upsert
from strata.sources.files import file_inventory, move_partitions, partition_directories, remove_path, restore_partitions
from strata.sources.key_index import index_keys, may_hold
from strata.sources.readers import in_partitions, listed_days, read_parquet


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str], gathered: bool = False) -> None:
    """Overwrite exactly the partitions present in ``df``.

    The rebalance hint gathers a partition's rows to avoid small files, and lets adaptive
    execution split a partition that is too large for one task. Rows that are ``gathered`` already, as in the
    files of a table with the same partitions, are written where they are read, without a shuffle.
    """
    _overwrite_partitions(df if gathered else df.hint("rebalance", *columns), path, columns)


class WriteCount(NamedTuple):
    observed: int
    in_footers: int


def replace_partitions_counted(df: DataFrame, path: str, columns: Sequence[str]) -> WriteCount:
    """The same, with the rows counted twice: while they are written, and from the footers of what was written.

    The first number costs nothing and the second one job over footers; they differ if a task that was
    repeated counted its rows again, so only the second one may decide.
    """
    spark, seen = df.sparkSession, Observation()
    replace_partitions(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, columns)
    touched = in_partitions(spark.read.parquet(path), columns[0], df.select(columns[0]))
    return WriteCount(seen.get["rows"], touched.count())


def promote(spark: SparkSession, staged_path: str, path: str) -> list[str]:
    """Replace partitions of a table by those of a staged copy, by moving directories; returns their names."""
    return move_partitions(spark, staged_path, path)


def stage(df: DataFrame, staged_path: str, columns: Sequence[str], gathered: bool = False) -> None:
    df = df if gathered else df.hint("rebalance", *columns)
    df.write.mode("overwrite").partitionBy(*columns).parquet(staged_path)


def _overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_once(df: DataFrame, path: str) -> None:
    """Write a table unless it already exists."""
    df.write.mode("ignore").parquet(path)


def split_by_day(df: DataFrame, path: str, timestamp: str, column: str = "date", first_day=None) -> None:
    """One directory per day of ``timestamp``; rows without one, or before ``first_day``, are left out.

    Only the days that occur are replaced, so later parts of a month can follow earlier ones.
    """
    dated = df.withColumn(column, F.to_date(timestamp))
    kept = dated.where(F.col(column).isNotNull())
    if first_day is not None:
        kept = kept.where(F.col(column) >= F.lit(first_day))
    replace_partitions(kept, path, [column])


def few_files(spark: SparkSession, path: str, column: str, days: Sequence, per_day: int = 16) -> bool:
    """Whether the days' files are few enough to be copied as they are; many small ones should be gathered."""
    return file_inventory(spark, path, [f"{column}={day.isoformat()}" for day in days]).count() <= per_day * len(days)


class Ingested(NamedTuple):
    ingested_days: int
    skipped_days: int
    rows: int


def append_new_days(
    spark: SparkSession,
    landing: str,
    bronze: str,
    days: DateRange,
    landing_day: str = "date",
    bronze_day: str = "ingestion_date",
) -> Ingested:
    """Load the days of the range that landed and are not in bronze yet.

    A day that is missing in landing or already present in bronze is skipped and counted; so are all
    days while there is no landing folder. Only directories of the range are looked up. The list of new
    days becomes a literal filter, so only those landing directories are read, in one job for all days.
    """
    known = set(listed_days(spark, bronze, bronze_day, days))
    new_days = [day for day in listed_days(spark, landing, landing_day, days) if day not in known]
    if not new_days:
        return Ingested(0, days.n_days, 0)
    increment = (
        spark.read.parquet(landing)
        .where(F.col(landing_day).isin(new_days))
        .withColumn(bronze_day, F.col(landing_day).cast("date"))
        .drop(*({landing_day} - {bronze_day}))
    )
    replace_partitions(increment, bronze, [bronze_day], gathered=few_files(spark, landing, landing_day, new_days))
    # Counted from the footers of the new files: a counter inside the job would run twice for
    # a task that is repeated after losing an executor.
    rows = spark.read.parquet(bronze).where(F.col(bronze_day).isin(new_days)).count()
    return Ingested(len(new_days), days.n_days - len(new_days), rows)


def upsert_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    key_fixes_partition: bool = True,
    index_path: str | None = None,
    gathered: bool = False,
) -> None:
    """Upsert ``source`` into a Parquet table partitioned by one column.

    If a key always stays in one partition, only the partitions named by the source are
    read and rewritten. Otherwise the keys are also looked up in all other partitions, or with ``index_path`` (see
    ``key_index``, which is then kept up) in those that may hold one, and
    those with a match are rewritten too, or removed if nothing remains. Either way the
    result is staged before it replaces anything. A source with two rows for one key is
    refused, because either could win. NULL is a partition like any other. A source whose rows are ``gathered`` by
    partition already is copied without a shuffle.
    """
    restore_partitions(spark, path)
    target = read_parquet(spark, path, missing_ok=True)
    like = source if target is None else target
    # The source is computed once; the directories of its copy name the partitions it touches.
    source_path = beside(path, "upsert-source")
    stage(source.select(*like.columns), source_path, [partition], gathered)
    increment = spark.read.schema(like.schema).parquet(source_path).select(*like.columns)
    if not repeated_keys(increment, keys).isEmpty():
        remove_path(spark, source_path)
        raise ValueError(f"the source of an upsert repeats a key of {list(keys)}")
    if target is None:
        promote(spark, source_path, path)
        remove_path(spark, source_path)
        if index_path is not None:
            index_keys(spark, path, index_path, keys, partition)
        return
    touched = stored(increment.select(partition).distinct(), "touched")
    if not key_fixes_partition:
        searched = target
        if index_path is not None:
            searched = in_partitions(target, partition, may_hold(spark, path, index_path, increment, keys, partition))
        touched = touched.union(searched.join(increment.select(*keys), list(keys), "left_semi").select(partition))
        touched = stored(touched.distinct(), "touched")
    affected = in_partitions(target, partition, touched)
    staged_path = beside(path, "upsert")
    stage(upsert(affected, increment, keys), staged_path, [partition])
    emptied = []
    if not key_fixes_partition:
        staged = spark.read.schema(like.schema).parquet(staged_path)
        emptied = partition_directories(affected, partition) - partition_directories(staged, partition)
    promote(spark, staged_path, path)
    for directory in (*(f"{path.rstrip('/')}/{name}" for name in sorted(emptied)), staged_path, source_path):
        remove_path(spark, directory)
    if index_path is not None:
        index_keys(spark, path, index_path, keys, partition, touched)


def backfill_column(
    spark: SparkSession, path: str, column: str, value, partition: str
) -> int:
    """Fill a column that is NULL in old rows; returns the number of rows that were NULL.

    Only partitions that hold such rows are rewritten. ``value`` maps the DataFrame to the
    replacement Column. A table without the column gets it.
    """
    restore_partitions(spark, path)
    table = spark.read.parquet(path)
    if column not in table.columns:
        table = table.withColumn(column, F.lit(None).cast("string"))
    holes = table.groupBy(partition).agg(F.count_if(F.col(column).isNull()).alias("_nulls"))
    n_nulls = holes.agg(F.coalesce(F.sum("_nulls"), F.lit(0)).alias("n")).first()["n"]
    if n_nulls == 0:
        return 0
    affected = in_partitions(table, partition, holes.where("_nulls > 0").select(partition))
    filled = affected.withColumn(column, F.coalesce(F.col(column), value(affected)))
    staged_path = beside(path, "backfill")
    stage(filled, staged_path, [partition])
    promote(spark, staged_path, path)
    remove_path(spark, staged_path)
    return n_nulls


def rewrite_table(df: DataFrame, path: str, backup_path: str) -> None:
    """Replace an unpartitioned table as a whole, after copying the old one to ``backup_path``.

    ``df`` may read ``path`` itself: it is computed completely before the old files go.
    """
    spark = df.sparkSession
    staged_path = shared_dir(spark, "rewrite")
    spark.read.parquet(path).write.mode("error").parquet(backup_path)
    df.write.parquet(staged_path)
    spark.read.parquet(staged_path).write.mode("overwrite").parquet(path)
    remove_path(spark, staged_path)

"""Table maintenance: compaction, expiry of old runs, orphan files, and a combined job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.config import beside, stored
from strata.sources.contracts import contract
from strata.sources.files import file_inventory, move_partitions, remove_older, remove_path, restore_partitions
from strata.sources.publish import add_to_manifest, read_log, read_manifest
from strata.sources.readers import literal_table

TARGET_FILE_BYTES = 128 * 1024 * 1024  # fixed value: documented target file size
DAYS_TO_KEEP = 30  # fixed value: documented retention
RETAIN_LAST = 10  # fixed value: newest versions that are always kept


def compaction_plan(
    spark: SparkSession, path: str, partition_columns: Sequence[str], target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Per partition: files and bytes now, and the number of files it should have."""
    return (
        file_inventory(spark, path)
        .groupBy(*partition_columns)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .withColumn("target_files", F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))))
    )


def compact(
    spark: SparkSession, path: str, partition_columns: Sequence[str], target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Rewrite partitions with at least twice the files their size needs; rows do not change.

    The new files are written aside and counted before their directories take the place of the old ones: a
    run that fails earlier changes nothing, and one that fails while moving is completed by the next, which first
    puts back what had stepped aside. Rows
    are dealt out over the target files by file and row position, which a retried task reproduces: a
    partition with a third of all bytes is written by as many tasks as it gets files. NULL is a partition
    like any other. Returns files and bytes per partition before and after.
    """
    columns = list(partition_columns)
    restore_partitions(spark, path)
    before = stored(compaction_plan(spark, path, columns, target_bytes), "compact-report")
    work = before.where(F.col("files") >= 2 * F.col("target_files"))
    table = spark.read.parquet(path)
    position = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    placed = table.select("*", position.alias("_position"))
    renamed = work.select(*(F.col(c).alias(f"_{c}") for c in columns), "target_files")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))
    affected = placed.join(renamed, same)
    sizes = affected.groupBy(*columns, "target_files").agg(F.count(F.lit(1)).alias("rows")).agg(
        F.sum("rows").alias("rows"),
        F.sum("target_files").alias("files"),
        F.max(F.ceil(F.col("rows") / F.col("target_files"))).alias("rows_per_file"),
    )
    size = sizes.first()
    if size["rows"] is not None:
        staged_path = beside(path, "compact")
        (
            affected.withColumn("_file", F.pmod("_position", "target_files"))
            .repartition(size["files"], *columns, "_file")
            .select(*table.columns)
            .write.option("maxRecordsPerFile", int(size["rows_per_file"] * 1.2) + 1)
            .partitionBy(*columns)
            .parquet(staged_path)
        )
        written = spark.read.schema(table.schema).parquet(staged_path).count()
        if written != size["rows"]:
            raise RuntimeError(f"the new files of {path} hold {written} rows, the old ones {size['rows']}")
        move_partitions(spark, staged_path, path)
        remove_path(spark, staged_path)
    sizes = {"files": "files_before", "bytes": "bytes_before"}
    after = compaction_plan(spark, path, columns, target_bytes).select(
        *(F.col(c).alias(f"_{c}") for c in columns),
        F.col("files").alias("files_after"),
        F.col("bytes").alias("bytes_after"),
    )
    report = before.drop("target_files").withColumnsRenamed(sizes).join(after, same)
    return report.drop(*(f"_{c}" for c in columns))


def newest_versions(log: DataFrame, table: str, version: str, time: str, n: int) -> DataFrame:
    """The ``n`` newest versions of each table; map tasks forward at most ``n`` rows per table."""
    window = Window.partitionBy(table).orderBy(F.col(time).desc(), F.col(version).desc())
    return log.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def expire_candidates(
    log: DataFrame,
    as_of: Column,
    table: str = "table_path",
    version: str = "run_id",
    time: str = "committed_at",
    days_to_keep: int = DAYS_TO_KEEP,
    retain_last: int = RETAIN_LAST,
) -> DataFrame:
    """Versions older than the retention that are not among the newest of their table.

    Only the few versions to keep are ranked; all others are found by an anti join on
    (table, version), so the history of one busy table is never gathered in one task.
    """
    kept = newest_versions(log.select(table, version, time), table, version, time, retain_last)
    old = log.where(F.col(time) < as_of - F.make_dt_interval(F.lit(days_to_keep)))
    return old.join(kept.select(table, version), [table, version], "left_anti")


def orphans(inventory: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Files that no live version refers to. References are made distinct before the join."""
    return inventory.join(manifest.select(path).distinct(), path, "left_anti")


@dataclass(frozen=True)
class MaintainedTable:
    path: str
    partition_columns: tuple[str, ...]
    log_path: str | None = None
    manifest_path: str | None = None


MODES = {
    "weekly": ("compact",),
    "monthly": ("expire", "orphans"),
    "full": ("compact", "expire", "orphans"),
}
RESULT_SCHEMA = contract(step="string", table_path="string", ok="boolean", items="long", detail="string")


def maintain(
    spark: SparkSession,
    tables: Sequence[MaintainedTable],
    mode: str = "full",
    skip: Sequence[str] = (),
    as_of: dt.datetime | None = None,
    days_to_keep: int = DAYS_TO_KEEP,
    retain_last: int = RETAIN_LAST,
    remove_after_days: int | None = None,
) -> DataFrame:
    """Run the steps of ``mode`` on every table; one failing table does not stop the rest.

    ``skip`` applies to mode ``full``. ``items`` counts rewritten partitions, expired runs
    and orphan files. The run that readers see never expires. Orphan files are only reported, because a
    file of a write still in progress is not in any manifest either; with ``remove_after_days`` those that
    are older than that go, and staged copies of refused runs of the same age with them.
    """
    steps = [s for s in MODES[mode] if mode != "full" or s not in skip]
    now = as_of or dt.datetime.now(dt.timezone.utc)
    results = []
    for step in steps:
        for table in tables:
            try:
                items = _run_step(spark, step, table, now, days_to_keep, retain_last, remove_after_days)
                results.append((step, table.path, True, items, None))
            except Exception as error:  # noqa: BLE001 - reported in the result
                said = str(error).splitlines() or [type(error).__name__]
                results.append((step, table.path, False, None, said[0]))
    return literal_table(spark, results, RESULT_SCHEMA)


def _run_step(
    spark: SparkSession, step: str, table: MaintainedTable, now: dt.datetime, days: int, retain: int, remove: int | None
) -> int:
    visible_run = None
    if table.log_path is not None:
        log = read_log(spark, table.log_path).where(F.col("table_path") == table.path)
        visible = newest_versions(log.where("published"), "table_path", "run_id", "committed_at", 1)
        visible_run = visible.select("table_path", "run_id").first()
    if visible_run is None and (step != "compact" or table.manifest_path is not None):
        raise ValueError(f"no published run of {table.path} is known")  # before anything is rewritten
    if step == "compact":
        rewritten = compact(spark, table.path, table.partition_columns)
        n = rewritten.where("files_after < files_before").count()
        if n and table.manifest_path is not None:
            new = orphans(file_inventory(spark, table.path), _manifest(spark, table))
            entries = new.select(
                F.lit(table.path).alias("table_path"), F.lit(visible_run.run_id).alias("run_id"), "path"
            )
            add_to_manifest(entries, table.manifest_path)
        return n
    if step == "expire":
        expired = expire_candidates(log, F.lit(now), days_to_keep=days, retain_last=retain)
        return drop_runs(spark, table, expired.where(F.col("run_id") != visible_run.run_id), visible_run.run_id)
    found = stored(
        orphans(file_inventory(spark, table.path), _manifest(spark, table)).select("path", "modificationTime"), "orphans"
    )
    if remove is not None:
        cutoff = now - dt.timedelta(days=remove)
        for row in found.where(F.col("modificationTime") < F.lit(cutoff)).select("path").toLocalIterator():
            remove_path(spark, row.path)
        remove_older(spark, f"{table.path.rstrip('/')}_staging", cutoff)
    return found.count()


def _manifest(spark: SparkSession, table: MaintainedTable) -> DataFrame:
    return read_manifest(spark, table.manifest_path).where(F.col("table_path") == table.path)


def drop_runs(spark: SparkSession, table: MaintainedTable, expired: DataFrame, heir: str) -> int:
    """Remove expired runs from the publish log and the manifest; returns how many runs went.

    Files of an expired run that still exist belong to partitions no later run has replaced; their entries
    pass on to ``heir``. Only the directories of expired runs are touched, so entries that are being added
    meanwhile are safe, and an interrupted removal is completed by the next.
    """
    gone = stored(expired.select("table_path", "run_id").distinct(), "expired")
    count = gone.count()
    if count:
        runs = [row.run_id for row in gone.select("run_id").collect()]  # one name per expired run
        if table.manifest_path is not None:
            old = _manifest(spark, table).where(F.col("run_id").isin(runs))
            alive = old.join(file_inventory(spark, table.path).select("path"), "path", "left_semi")
            inherited = alive.select("table_path", F.lit(heir).alias("run_id"), "path").distinct()
            add_to_manifest(stored(inherited, "inherited"), table.manifest_path)
            _drop_directories(spark, old, table.manifest_path)
        log = read_log(spark, table.log_path).where((F.col("table_path") == table.path) & F.col("run_id").isin(runs))
        _drop_directories(spark, log, table.log_path)
    return count


def _drop_directories(spark: SparkSession, entries: DataFrame, path: str) -> None:
    directory = F.regexp_extract("_metadata.file_path", "(table_path=[^/]*/run_id=[^/]*)/[^/]*$", 1)
    for row in entries.select(directory.alias("name")).distinct().collect():
        remove_path(spark, f"{path.rstrip('/')}/{unquote(row.name)}")

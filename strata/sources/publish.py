"""Write-audit-publish over Parquet directories.

An increment is written to a staging directory, audited there, and only then moves into
the table: its partition directories take the place of the old ones, so rows are written
once. A failed audit leaves the staged copy for inspection. An exception before the move removes it; from
then on it stays until everything is in place, so that a failure never takes the only copy of a row.
Publishing is atomic per partition directory at best: readers of several tables can see one published
before the other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.audit import run_checks
from strata.sources.contracts import contract
from strata.sources.files import data_file_counts, file_inventory, remove_path, restore_partitions
from strata.sources.readers import literal_table
from strata.sources.writers import promote, stage

LOG_SCHEMA = contract(
    table_path="string",
    run_id="string",
    published="boolean",
    rows="long",
    files="long",
    committed_at="timestamp",
)
MANIFEST_SCHEMA = contract(table_path="string", run_id="string", path="string")


class PublishResult(NamedTuple):
    run_id: str
    published: bool
    audit: dict[str, bool]
    staged_path: str


def staged_copy(path: str, run_id: str) -> str:
    """Where a run stages what it publishes into a table."""
    return f"{path.rstrip('/')}_staging/{run_id}"


def publish(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str],
    checks: dict[str, Column],
    run_id: str,
    log_path: str | None = None,
    manifest_path: str | None = None,
    committed_at: dt.datetime | None = None,
    gathered: bool = False,
    staged: bool = False,
) -> PublishResult:
    """Stage, audit and, if that passes, move into the table; ``gathered`` as in ``replace_partitions``.

    What is ``staged`` lies in the staged copy of the run already; ``df`` then only tells its columns.
    """
    spark = df.sparkSession
    staged_path = staged_copy(path, run_id)
    stamp = committed_at or dt.datetime.now(dt.timezone.utc)
    restore_partitions(spark, path)
    try:
        if not staged:
            stage(df, staged_path, partition_columns, gathered)
        # The declared schema keeps an empty increment readable.
        rows_staged = spark.read.schema(df.schema).parquet(staged_path).select(*df.columns)
        found = run_checks(rows_staged, {**checks, "_rows": F.count(F.lit(1))}).first().asDict()
        rows, files = found.pop("_rows"), sum(data_file_counts(spark, staged_path).values())
        audit = {name: bool(value) for name, value in found.items()}
        passed = all(audit.values())
    except Exception:
        remove_path(spark, staged_path)
        raise
    touched = promote(spark, staged_path, path) if passed else []
    if touched and manifest_path is not None:
        record_manifest(spark, path, run_id, manifest_path, touched)
    if log_path is not None:
        row = (path, run_id, passed, rows, files, stamp)
        write_log(literal_table(spark, [row], LOG_SCHEMA), log_path)
    if passed:
        remove_path(spark, staged_path)
    return PublishResult(run_id, passed, audit, staged_path)


def write_log(entries: DataFrame, log_path: str) -> None:
    """One directory per table and run, so a repeated run replaces its entry and tables never meet."""
    _by_run(entries, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(log_path)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log_path)


def record_manifest(
    spark: SparkSession, path: str, run_id: str, manifest_path: str, directories: list[str] | None = None
) -> None:
    """Note the files that a run put in place: those of the given partitions, or of the whole table.

    A file stays on the list for as long as it exists, so the lists of all runs together name every live file.
    """
    files = file_inventory(spark, path, directories)
    add_to_manifest(files.select(F.lit(path).alias("table_path"), F.lit(run_id).alias("run_id"), "path"), manifest_path)


def add_to_manifest(entries: DataFrame, manifest_path: str) -> None:
    _by_run(entries, "append").parquet(manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)


def _by_run(entries: DataFrame, mode: str):
    return entries.write.mode(mode).partitionBy("table_path", "run_id")

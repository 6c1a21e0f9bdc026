"""Reading partitioned tables by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import DateRange
from strata.sources.contracts import require_contract
from strata.sources.files import file_inventory, path_exists


def read_table(spark: SparkSession, name: str, missing_ok: bool = False) -> DataFrame | None:
    """A catalog table; with ``missing_ok`` None when it does not exist."""
    if missing_ok and not spark.catalog.tableExists(name):
        return None
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame | None:
    """A Parquet directory; with ``missing_ok`` None when the path does not exist.

    Only a missing path is forgiven. Any other read error is raised.
    """
    if missing_ok and not path_exists(spark, path):
        return None
    return spark.read.parquet(path)


def read_contract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw files whose own schema is checked against the declared one before anything is read."""
    return require_contract(spark.read.parquet(path), schema)


def in_partitions(df: DataFrame, column: str, touched: DataFrame, others: bool = False) -> DataFrame:
    """Rows of the partitions that ``touched`` names in its only column, the NULL partition included, or of all others.

    At most one value per partition is collected; as a literal filter it reads only those directories.
    """
    values = [row[0] for row in touched.distinct().collect()]
    kind = df.schema[column].dataType
    wanted = F.col(column).isin([F.lit(v).cast(kind) for v in values if v is not None])
    if others:
        return df.where((~wanted & F.col(column).isNotNull()) if None in values else F.coalesce(~wanted, F.lit(True)))
    return df.where(wanted | F.col(column).isNull() if None in values else wanted)


def listed_days(spark: SparkSession, path: str, column: str, days: DateRange) -> list[dt.date]:
    """Days of the range that have a partition directory; other directories are not listed."""
    each = (days.start + dt.timedelta(days=n) for n in range(days.n_days))
    return [day for day in each if path_exists(spark, f"{path.rstrip('/')}/{column}={day.isoformat()}")]


def present_days(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """Days that have a partition directory, from the file listing alone; None without a table."""
    if not path_exists(spark, path):
        return None
    listed = file_inventory(spark, path)
    if column not in listed.columns:  # a table without files has no partitions to discover
        return listed.select(F.lit(None).cast("date").alias(column)).limit(0)
    return listed.select(column).distinct()


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows as a DataFrame, without starting Python workers."""
    structs = [
        F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)))
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def within(df: DataFrame, column: str, days: DateRange) -> DataFrame:
    """Rows of the inclusive day range; on a partition column Spark reads only those directories."""
    kind = df.schema[column].dataType
    # Compare in the column's own type: a cast around it would defeat partition pruning.
    first, last = F.lit(days.start), F.lit(days.end)
    if isinstance(kind, T.StringType):
        first, last = F.lit(days.start.isoformat()), F.lit(days.end.isoformat())
    return df.where(F.col(column).between(first, last))


def read_range(spark: SparkSession, path: str, column: str, days: DateRange) -> DataFrame:
    return within(spark.read.parquet(path), column, days)


def read_range_or_none(spark: SparkSession, path: str, column: str, days: DateRange) -> DataFrame | None:
    """Like ``read_range``, but None when the range holds no row or the table does not exist."""
    table = read_parquet(spark, path, missing_ok=True)
    if table is None:
        return None
    found = within(table, column, days)
    return None if found.isEmpty() else found


def read_day(spark: SparkSession, path: str, column: str, day: str) -> DataFrame:
    return read_range(spark, path, column, DateRange.of(day))


def missing_days(spark: SparkSession, days: DateRange, present: DataFrame | None, column: str) -> DataFrame:
    """Days of the range without any row in ``present``; column ``day``."""
    spine = days.spine(spark)
    if present is None:
        return spine
    found = within(present, column, days).select(F.col(column).cast("date").alias("day")).distinct()
    return spine.join(found, "day", "left_anti")


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))

"""Catalog tables: create, evolve, list and drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_if_absent(df: DataFrame, table: str, partition_columns: Sequence[str] = ()) -> bool:
    """Create a Parquet table from ``df`` on first use; False when it already exists."""
    if df.sparkSession.catalog.tableExists(table):
        return False
    writer = df.write.format("parquet")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.saveAsTable(table)
    return True


def has_column(spark: SparkSession, table: str, column: str) -> bool:
    return column in spark.table(table).columns


def add_column_if_missing(spark: SparkSession, table: str, column: str, sql_type: str = "string") -> bool:
    """Add a column; False when the table already has it."""
    if has_column(spark, table, column):
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMN {column} {sql_type}")
    return True


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def drop_tables(spark: SparkSession, tables: Sequence[str], database: str = "default") -> DataFrame:
    """Drop the named tables where present; returns the tables that remain."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return list_tables(spark, database)

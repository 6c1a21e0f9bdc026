"""Tables whose files have different schemas, read under one declared schema without rewriting any of them.

A column that older files lack is NULL in their rows, or computed while reading; a number that was narrower is widened
by the reader. Which changes a declared schema may bring is checked before anything is read under it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.contracts import SchemaDifference
from strata.sources.files import leaf_directories

#: Types whose values a reader widens to the declared type.
WIDER = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
    ("int", "bigint"), ("float", "double"),
}


def broken_promises(found: T.StructType, declared: T.StructType) -> list[SchemaDifference]:
    """Columns of written files that the declared schema neither has nor widens; new columns break nothing."""
    names = {f.name: f.dataType.simpleString() for f in declared.fields}
    kinds = {f.name: f.dataType.simpleString() for f in found.fields}
    return [
        SchemaDifference(name, names.get(name), kind)
        for name, kind in kinds.items()
        if names.get(name) != kind and (kind, names.get(name)) not in WIDER
    ]


def written_schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Schema of each partition directory, from the footer of one of its files; writers replace whole directories."""
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}").schema for name in leaf_directories(spark, path)}


def require_readable(spark: SparkSession, path: str, declared: T.StructType) -> None:
    for name, found in written_schemas(spark, path).items():
        broken = broken_promises(found, declared)
        if broken:
            raise ValueError(f"{name} cannot be read under the declared schema: {broken}")


def read_under(
    spark: SparkSession, path: str, declared: T.StructType, fill: dict[str, Callable[[DataFrame], Column]] | None = None
) -> DataFrame:
    """All files under one schema; ``fill`` maps a column to the value that stands for its NULLs, such as those of older files.

    Filters on columns that are not filled reach the scan, and files that lack a column are not opened for it.
    """
    table = spark.read.schema(declared).parquet(path)
    return table.withColumns({name: F.coalesce(F.col(name), value(table)) for name, value in (fill or {}).items()})

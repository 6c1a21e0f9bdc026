"""Order-dependent operators that survive a hot key.

A plain window sends all rows of a key to one task. That is fine for keys no larger than an
average task. The rows of a larger key are cut into slices by a range partitioning on their full
order, ties included, so a slice holds about 1/n of them however they are spread over time. Work
then runs per (key, slice), and only one summary row per slice of a hot key is carried across slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import stored

SLICE = "_slice"


def join_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """The key columns in a form without NULLs: value or a stand-in, and whether it is NULL.

    Equality on them treats a NULL key as a group like any other, and unlike a null-safe
    comparison it lets a join reuse the partitioning and sort order of a window.
    """
    columns = {}
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        if isinstance(kind, T.NumericType):
            stand_in = "0"
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            stand_in = "1970-01-01"
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            stand_in = ""
        elif isinstance(kind, T.BooleanType):
            stand_in = "false"
        else:
            raise TypeError(f"{kind.simpleString()} column {key} cannot be a series key")
        columns[f"_key{i}"] = F.coalesce(F.col(key), F.lit(stand_in).cast(kind))
        columns[f"_null{i}"] = F.col(key).isNull()
    return columns


def cut(df: DataFrame, order: Sequence[str], n_slices: int | None = None, name: str = "slices") -> DataFrame:
    """Add ``_slice``, a number that never decreases along ``order``, by range partitions of equal size.

    The rows are written with their slice: every later reader, and a task that is run again, sees the
    same cut. NULLs come first, as in an ascending window; NaN comes last.
    """
    dealt = df.repartitionByRange(n_slices, *order) if n_slices else df.repartitionByRange(*order)
    return stored(dealt.withColumn(SLICE, F.spark_partition_id()), name)


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], n_slices: int | None = None) -> DataFrame:
    """Add ``_slice``: NULL for ordinary keys; for hot keys a number that never decreases along ``order``.

    A key is hot when it has more rows than the average of ``n_slices`` tasks, so there are fewer
    than ``n_slices`` such keys and their list can be broadcast. ``order`` must be unique within a key;
    rows whose time is NULL come first, for hot and ordinary keys alike.
    """
    spark = df.sparkSession
    key = join_keys(df, keys)  # refuses keys of other types before anything runs
    n_slices = n_slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    sizes = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-sizes")
    average = sizes.agg(F.sum("_rows") / n_slices).first()[0]
    hot = sizes.where(F.col("_rows") > F.lit(average))
    if hot.isEmpty():
        return df.withColumn(SLICE, F.lit(None).cast("int"))
    marks = F.broadcast(hot.select(*(c.alias(n) for n, c in join_keys(hot, keys).items()), F.lit(True).alias("_hot")))
    marked = df.withColumns(key).join(marks, list(key), "left").drop(*key)
    sliced = cut(marked.where("_hot").drop("_hot"), [*keys, *order], n_slices)
    ordinary = marked.where("_hot IS NULL").drop("_hot").withColumn(SLICE, F.lit(None).cast("int"))
    return ordinary.unionByName(sliced)


def running_sum(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    total: str | None = None,
    all_sliced: bool = False,
) -> DataFrame:
    """Running total of ``value`` per key up to and including the current row.

    Inside a slice a window does it; the total of all earlier slices is added from the
    per-slice sums. ``order`` must be unique within a key. ``total`` names an optional
    column with the sum over the whole key. ``all_sliced`` says that no slice is NULL: both
    sides of the join then share one shuffle of their input.
    """
    key = join_keys(sliced, keys)
    rows = sliced.withColumns({"_value": value, **key})
    group = Window.partitionBy(*key, SLICE)
    inside = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*key)
    before = across.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    slice_sum = F.sum("_slice_sum")
    offsets = (
        (rows if all_sliced else _hot_rows(rows))
        .groupBy(*key, SLICE)
        .agg(F.sum("_value").alias("_slice_sum"))
        .select(*key, SLICE, slice_sum.over(before).alias("_offset"), slice_sum.over(across).alias("_sum"))
    )
    results = {out: F.col("_running") + F.coalesce("_offset", F.lit(0))}
    if total:
        rows = rows.withColumn("_group_sum", F.sum("_value").over(group))
        results[total] = F.coalesce("_sum", "_group_sum")
    return (
        rows.withColumn("_running", F.sum("_value").over(inside))
        .join(offsets, [*key, SLICE], "left")
        .withColumns(results)
        .drop("_value", "_running", "_group_sum", "_offset", "_sum", *key)
    )


def _hot_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(SLICE).isNotNull())


def previous_row(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """``columns`` of the preceding row of the same key, NULL for the first row of a key.

    Looks back inside the slice, and for the first row of a slice into the last row of the
    nearest earlier slice of that key. ``order`` must be unique within a key.
    """
    payload = [*order, *(c for c in columns if c not in order)]
    key = join_keys(sliced, keys)
    rows = sliced.withColumns({"_current": F.struct(*payload), **key})
    inside = Window.partitionBy(*key, SLICE).orderBy(*order)
    across = Window.partitionBy(*key).orderBy(SLICE)
    carried = (
        _hot_rows(rows)
        .groupBy(*key, SLICE)
        .agg(F.max("_current").alias("_last"))
        .select(*key, SLICE, F.lag("_last").over(across).alias("_carried"))
    )
    previous = F.coalesce("_previous", "_carried")
    return (
        rows.withColumn("_previous", F.lag("_current").over(inside))
        .join(carried, [*key, SLICE], "left")
        .withColumns({f"{prefix}{c}": previous[c] for c in columns})
        .drop("_current", "_previous", "_carried", *key)
    )


def runs(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column
) -> DataFrame:
    """Maximal runs of consecutive rows on which ``condition`` holds.

    Rows between two failures share the number of failures seen so far, which names the run.
    Returns the keys, ``run_start``, ``run_end`` (both of the first order column) and ``run_rows``.
    """
    holds = F.coalesce(condition, F.lit(False))
    numbered = running_sum(sliced, keys, order, F.when(holds, 0).otherwise(1), "_run")
    return (
        numbered.where(holds)
        .groupBy(*keys, "_run")
        .agg(
            F.min(order[0]).alias("run_start"),
            F.max(order[0]).alias("run_end"),
            F.count(F.lit(1)).alias("run_rows"),
        )
        .drop("_run")
    )

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import stored
from strata.sources.files import remove_path

__all__ = ["forget", "numbered", "pieces", "stored", "table", "utf8", "whole_text"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once nothing reads them any more."""
    for written in tables:
        for file in written.inputFiles()[:1]:
            remove_path(written.sparkSession, file.rsplit("/", 1)[0])


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def pieces(batch: pa.RecordBatch, byte_limit: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``byte_limit`` bytes, so Python copies stay bounded."""
    if batch.num_rows == 0:
        return
    rows = max(1, batch.num_rows * byte_limit // max(1, batch.column(column).nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def numbered(rows: DataFrame, order: list[Column], name: str, out: str = "place") -> DataFrame:
    """The rows with their place, from 1, along ``order``, which should be total so that equal rows can be parted.

    Range partitions are sorted and written with the number of each row in its partition; the rows of all
    earlier partitions are then added from one count per partition, of which there are as many as tasks.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    # The number has the partition above 33 bits and the row below.
    split = dealt.withColumn("_part", F.shiftright("_at", 33)).withColumn("_nth", F.col("_at").bitwiseAND((1 << 33) - 1))
    before, starts = 0, []
    for part, size in sorted(map(tuple, split.groupBy("_part").count().collect())):
        starts.append((part, before))
        before += size
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part long, _before long"))
    place = (F.col("_before") + F.col("_nth") + 1).cast("long")
    return split.join(starts, "_part").withColumn(out, place).drop("_at", "_part", "_nth", "_before")

"""Incremental ingestion as a file-source stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.sources.writers import few_files, replace_partitions


def stream_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    landing_day: str = "date",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Landing files as a stream; the day of a row is the day of its directory."""
    partitioned = T.StructType([*schema.fields, T.StructField(landing_day, T.DateType())])
    reader = spark.readStream.schema(partitioned)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing)


def write_bronze(
    stream: DataFrame, landing: str, bronze: str, checkpoint: str, landing_day: str = "date", bronze_day: str = "ingestion_date"
) -> StreamingQuery:
    """Bring the days of all files that arrived since the last run into bronze and stop.

    The stream only says which days changed. Each of them is read from landing as a whole and replaces its
    bronze partition. So a day that landed again under new file names, or whose files arrive in several
    batches, is there once and complete, and a batch repeated after a failure changes nothing.
    """
    schema = stream.schema

    def replace_days(batch: DataFrame, _: int) -> None:
        days = [row[0] for row in batch.select(landing_day).distinct().collect()]  # directories of one batch
        landed = batch.sparkSession.read.schema(schema).parquet(landing).where(F.col(landing_day).isin(days))
        copied = landed.withColumn(bronze_day, F.col(landing_day)).drop(*({landing_day} - {bronze_day}))
        gathered = None not in days and few_files(batch.sparkSession, landing, landing_day, days)
        replace_partitions(copied, bronze, [bronze_day], gathered)

    return (
        stream.writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

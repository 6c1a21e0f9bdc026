"""Metric samples as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.telemetry import event_rate, seconds_between, state_breakdown
from strata.sources.contracts import SAMPLES

def stream_samples(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SAMPLES,
    files: str = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Sample files as a stream. Watermarks need TIMESTAMP, so ``ts`` is cast to it."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def watermarked_breakdown(
    stream: DataFrame, ts: str, labels: Sequence[str], width: str, lateness: str
) -> DataFrame:
    """Tumbling counts with bounded state: windows older than the watermark are closed and dropped."""
    return state_breakdown(stream.withWatermark(ts, lateness), ts, labels, width)


def watermarked_rate(
    stream: DataFrame, ts: str, series: Sequence[str], lateness: str, minutes: int = 5
) -> DataFrame:
    """Events per second and window with bounded state: a window is given once the watermark has passed it."""
    return event_rate(stream.withWatermark(ts, lateness), ts, series, minutes)


def watermarked_sessions(stream: DataFrame, ts: str, series: Sequence[str], gap: str, lateness: str) -> DataFrame:
    """Activity sessions with bounded state: a session is given once it can no longer grow."""
    return sessions(stream.withWatermark(ts, lateness), ts, series, gap)


def silence_alerts(stream: DataFrame, ts: str, series: Sequence[str], gap_seconds: int, lateness: str) -> DataFrame:
    """Series that have been silent for ``gap_seconds``, as soon as the watermark proves it; bounded state.

    A closed session is followed by silence, so each gives one row: from its last sample on. State holds
    open sessions only. A series that never speaks again is reported as well, which a pair of sessions
    could not do.
    """
    closed = watermarked_sessions(stream, ts, series, f"{gap_seconds} seconds", lateness)
    last_sample = F.col("session_end") - F.make_dt_interval(secs=F.lit(gap_seconds))
    return closed.select(*series, last_sample.alias("silent_since"), F.col("session_end").alias("silent_until_at_least"))


def sessions(stream: DataFrame, ts: str, series: Sequence[str], gap: str) -> DataFrame:
    """Activity sessions: a series that stays silent for ``gap`` starts a new one; batch or stream."""
    return (
        stream.groupBy(F.session_window(ts, gap).alias("_session"), *series)
        .agg(F.count(F.lit(1)).alias("samples"))
        .select(
            *series,
            F.col("_session.start").alias("session_start"),
            F.col("_session.end").alias("session_end"),
            "samples",
        )
    )


def silence_between(found: DataFrame, series: Sequence[str], gap_seconds: int) -> DataFrame:
    """Silent stretches between the stored sessions of a series.

    A session ends one gap after its last sample. Sessions of a series are at least that
    far apart, so the window sees few rows however many samples there were.
    """
    following = Window.partitionBy(*series).orderBy("session_start")
    last_sample = F.col("session_end") - F.make_dt_interval(secs=F.lit(gap_seconds))
    return (
        found.select(
            *series,
            last_sample.alias("gap_start"),
            F.lead("session_start").over(following).alias("gap_end"),
        )
        .where(F.col("gap_end").isNotNull())
        .withColumn("seconds", seconds_between("gap_start", "gap_end"))
    )


def run_to_table(result: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Process everything that is available and stop.

    ``complete`` rewrites the table with each batch, ``append`` adds the closed groups. Both
    write from the executors; a batch that is repeated after a failure replaces its own
    earlier attempt.
    """
    if mode == "complete":

        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        writer = result.writeStream.outputMode("complete").foreachBatch(replace)
    else:
        writer = result.writeStream.outputMode(mode).format("parquet").option("path", path)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import telemetry
from strata.plans.queries import events
from strata.sources.contracts import SAMPLES, contract
from strata.streaming import ingest
from strata.streaming import telemetry as streams
from tests.conftest import SMALL, rows_of

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def split_events(spark):
    """The events table in six files, so that a stream sees several batches."""
    from strata.config import shared_dir

    path = shared_dir(spark, "events")
    events(spark, SMALL).repartition(6).write.parquet(path)
    return path


def test_breakdown_over_many_batches_equals_the_batch(spark, folder, split_events):
    root = folder("stream")
    stream = streams.stream_samples(spark, split_events, files_per_trigger=1)
    result = telemetry.state_breakdown(stream, "ts", ["event_type"], "1 hour")
    streams.run_to_table(result, f"{root}/table", f"{root}/checkpoint", "complete")
    batch = telemetry.state_breakdown(events(spark, SMALL), "ts", ["event_type"], "1 hour")
    found = spark.read.parquet(f"{root}/table").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert rows_of(found) == rows_of(batch)


def test_sessions_over_many_batches_equal_the_batch(spark, folder, split_events):
    root = folder("stream")
    stream = streams.stream_samples(spark, split_events, files_per_trigger=2)
    streams.run_to_table(
        streams.sessions(stream, "ts", ["user_id"], "6 hours"), f"{root}/table", f"{root}/checkpoint", "complete"
    )
    batch = events(spark, SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    assert rows_of(spark.read.parquet(f"{root}/table")) == rows_of(streams.sessions(batch, "ts", ["user_id"], "6 hours"))


def test_rows_behind_the_watermark_are_dropped(spark, folder):
    source, root = folder("samples"), folder("stream")

    def arrive(*minutes):
        data = [(m, START + dt.timedelta(minutes=m), 1, "a", 1.0, "") for m in minutes]
        spark.createDataFrame(data, SAMPLES).coalesce(1).write.mode("append").parquet(source)
        stream = streams.stream_samples(spark, source)
        closed = streams.watermarked_breakdown(stream, "ts", ["event_type"], "10 minutes", "20 minutes")
        streams.run_to_table(closed, f"{root}/table", f"{root}/checkpoint", "append")

    arrive(1, 5, 12)
    arrive(60)  # watermark moves to 00:40, so the windows at 00:00 and 00:10 are closed
    arrive(8, 45)  # 00:08 is too late; 00:45 is behind the newest sample but still accepted
    arrive(120)
    found = rows_of(spark.read.parquet(f"{root}/table"))
    assert [(r[0].hour * 60 + r[0].minute, r[2]) for r in found] == [(0, 2), (10, 1), (40, 1), (60, 1)]


def arrivals(spark, folder, form):
    """A function that lets samples at some minutes arrive and returns all rows given so far."""
    source, root = folder("samples"), folder("stream")

    def arrive(*minutes):
        data = [(m, START + dt.timedelta(minutes=m), u, "a", 1.0, "") for m, u in minutes]
        spark.createDataFrame(data, SAMPLES).coalesce(1).write.mode("append").parquet(source)
        streams.run_to_table(form(streams.stream_samples(spark, source)), f"{root}/table", f"{root}/checkpoint", "append")
        found = spark.read.parquet(f"{root}/table")
        minute = lambda t: (t - START).total_seconds() / 60
        return sorted(tuple(minute(v) if isinstance(v, dt.datetime) else v for v in r) for r in found.collect())

    return arrive


def test_late_rows_of_a_bounded_rate(spark, folder):
    arrive = arrivals(spark, folder, lambda s: streams.watermarked_rate(s, "ts", ["user_id"], "10 minutes"))
    arrive((1, 7), (2, 7))
    arrive((4, 7), (30, 7))  # 00:04 is in time; the watermark moves to 00:20
    found = arrive((3, 7), (60, 7))  # 00:03 comes after its window was given
    assert (0.0, 7, 3, 3 / 300) in found and len([r for r in found if r[0] == 0]) == 1


def test_late_rows_of_bounded_sessions(spark, folder):
    form = lambda s: streams.watermarked_sessions(s, "ts", ["user_id"], "5 minutes", "10 minutes")
    arrive = arrivals(spark, folder, form)
    arrive((1, 7), (12, 7))
    arrive((4, 7), (40, 7))  # joins the first session; the watermark moves to 00:30
    found = arrive((2, 7), (90, 7))  # too late
    assert found[:2] == [(7, 1.0, 9.0, 2), (7, 12.0, 17.0, 1)]


def test_silence_is_reported_for_series_that_never_return(spark, folder):
    arrive = arrivals(spark, folder, lambda s: streams.silence_alerts(s, "ts", ["user_id"], 600, "5 minutes"))
    arrive((1, 7), (3, 7), (2, 8))
    arrive((40, 8), (6, 7))  # in time for user 7
    found = arrive((5, 7), (41, 8))  # too late
    assert found == [(7, 6.0, 16.0), (8, 2.0, 12.0)]


def test_bronze_stream_holds_each_day_once(spark, folder):
    landing, root = folder("landing"), folder("stream")
    schema = contract(n="long")

    def land(day, n, mode="append"):
        rows = spark.range(n).select(F.col("id").alias("n"), F.lit(day).alias("date"))
        writer = rows.repartition(3).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date").parquet(landing)

    def run():
        stream = ingest.stream_landing(spark, landing, schema, files_per_trigger=1)
        ingest.write_bronze(stream, landing, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
        found = spark.read.parquet(f"{root}/bronze").groupBy("ingestion_date").count()
        return [(r[0].day, r[1]) for r in rows_of(found)]

    land(dt.date(2024, 1, 1), 5)
    assert run() == [(1, 5)]
    land(dt.date(2024, 1, 2), 30)
    assert run() == run() == [(1, 5), (2, 30)]
    land(dt.date(2024, 1, 2), 30, "overwrite")  # the same day again, under new names
    assert run() == [(1, 5), (2, 30)]
    land(dt.date(2024, 1, 1), 2)  # more of a known day
    assert run() == [(1, 7), (2, 30)]


def test_bronze_copies_days_of_few_files_without_a_shuffle(spark, folder, monkeypatch):
    calls, schema = [], contract(n="long")
    copied = ingest.replace_partitions
    monkeypatch.setattr(ingest, "replace_partitions", lambda *args: (calls.append(args[3]), copied(*args)))
    for files in (1, 20):
        landing, root = folder("landing"), folder("stream")
        rows = spark.range(0, 40, 1, files).select(F.col("id").alias("n"), F.lit("2024-01-05").cast("date").alias("date"))
        rows.write.partitionBy("date").parquet(landing)
        stream = ingest.stream_landing(spark, landing, schema)
        ingest.write_bronze(stream, landing, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
        assert rows_of(spark.read.parquet(f"{root}/bronze").select("n")) == sorted([(n,) for n in range(40)], key=repr)
    assert calls == [True, False]  # many small files are gathered

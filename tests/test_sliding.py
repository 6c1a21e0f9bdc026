from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import sliding
from strata.streaming import telemetry as streams
from tests.conftest import final_plan, rows_of

START = dt.datetime(2024, 1, 1, 10)


def at(minutes, seconds=0):
    return START + dt.timedelta(minutes=minutes, seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "event_id bigint, ts timestamp_ntz, kind string, value double")


def brute_force(rows, seconds=300, step=60):
    """Every range that ends at a step and holds a sample of a series."""
    found = {}
    for ts, kind, _ in rows:
        if ts is not None:
            first = int((ts - START).total_seconds() // step)
            for k in range(first + 1, first + seconds // step + 1):
                end = START + dt.timedelta(seconds=k * step)
                found[end, kind] = sum(1 for t, x, _ in rows if t is not None and x == kind and end - dt.timedelta(seconds=seconds) <= t < end)
    return sorted(((*key, n, n, n / seconds) for key, n in found.items()), key=repr)


def test_every_range_equals_its_samples(spark):
    rng = random.Random(4)
    rows = [(at(rng.randrange(0, 90), rng.randrange(60)), rng.choice(["a", "b", None]), 1.0) for _ in range(200)]
    rows += [(at(30, s % 60), "hot", 1.0) for s in range(400)] + [(None, "a", 1.0), (at(5), "edge", 1.0), (at(9, 59), "edge", 1.0)]
    steps = sliding.sliding_increase(frame(spark, rows), "ts", ["kind"])
    assert rows_of(steps) == brute_force(rows)
    wide = sliding.sliding_increase(frame(spark, rows), "ts", ["kind"], seconds=1800, step=600)
    assert rows_of(wide) == brute_force(rows, 1800, 600)


def test_a_burst_across_a_boundary_alerts(spark):
    """Two events on either side of 10:05: no tumbling window has three of them, a sliding range has four."""
    burst = frame(spark, [(at(4, 50), "a", 1.0), (at(4, 55), "a", 1.0), (at(5, 5), "a", 1.0), (at(5, 10), "a", 1.0)])
    from strata.operators.telemetry import increase_above

    assert increase_above(burst, "ts", ["kind"], 3).collect() == []
    episodes = sliding.alert_episodes(sliding.sliding_increase(burst, "ts", ["kind"]), ["kind"], 3)
    assert rows_of(episodes) == [("a", at(6), at(9), 4, 4)]


def test_episodes_end_where_a_step_is_quiet(spark):
    steps = spark.createDataFrame([(at(m), "a", v) for m, v in ((1, 5), (2, 6), (3, 2), (4, 9), (5, 1), (7, 8))], "range_end timestamp_ntz, kind string, increase long")
    assert rows_of(sliding.alert_episodes(steps, ["kind"], 4)) == [("a", at(1), at(2), 2, 6), ("a", at(4), at(4), 1, 9), ("a", at(7), at(7), 1, 8)]


def test_counters_grow_through_restarts(spark):
    rows = [(at(0), "a", 10.0), (at(1), "a", 14.0), (at(2), "a", 3.0), (at(3), "a", 5.0)]
    found = sliding.sliding_counter_increase(frame(spark, rows), "ts", ["kind"], ["ts", "event_id"], "value", 120, 60)
    assert [(r.range_end, r.increase) for r in found.orderBy("range_end").collect()] == [(at(1), 0.0), (at(2), 4.0), (at(3), 7.0), (at(4), 5.0), (at(5), 2.0)]


def test_a_hot_series_is_summed_before_the_shuffle(spark):
    plan = final_plan(sliding.sliding_increase(frame(spark, [(at(0), "a", 1.0)]), "ts", ["kind"]))
    assert plan.count("partial_sum") >= 2 and "Window" not in plan


def test_ranges_are_made_of_whole_steps(spark):
    with pytest.raises(ValueError, match="not made of steps"):
        sliding.sliding_increase(frame(spark, [(at(0), "a", 1.0)]), "ts", ["kind"], seconds=90)


def test_the_stream_gives_closed_ranges_of_the_batch(spark, folder):
    """Append mode: the last sample is far ahead, so all ranges before it are closed; state holds open panes only."""
    rng = random.Random(1)
    rows = [(at(rng.randrange(0, 40), rng.randrange(60)), rng.choice("ab"), 1.0) for _ in range(120)]
    landing, root = folder("samples"), folder("sliding")
    frame(spark, rows).coalesce(1).write.parquet(f"{landing}/first")
    frame(spark, [(at(600), "z", 1.0)]).coalesce(1).write.parquet(f"{landing}/second")
    frame(spark, [(at(700), "z", 1.0)]).coalesce(1).write.parquet(f"{landing}/third")
    schema = frame(spark, rows).schema
    stream = streams.stream_samples(spark, f"{landing}/*", schema, files_per_trigger=1)
    streams.run_to_table(sliding.sliding_stream(stream, "ts", ["kind"], "1 minute"), f"{root}/table", f"{root}/checkpoint", "append")
    found = spark.read.parquet(f"{root}/table").where("kind <> 'z'").withColumn("range_end", F.col("range_end").cast("timestamp_ntz"))
    assert rows_of(found) == sorted(((end, kind, n) for end, kind, n, _, _ in brute_force(rows)), key=repr)

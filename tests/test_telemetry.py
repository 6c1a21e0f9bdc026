from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import telemetry as t
from tests.conftest import rows_of

HOUR = dt.datetime(2024, 1, 1, 10)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, HOUR + dt.timedelta(minutes=m), kind, v) for i, (m, kind, v) in enumerate(rows)],
        "event_id bigint, ts timestamp_ntz, kind string, value double",
    )


def test_quiet_hours_are_reported(spark):
    df = frame(spark, [(0, "ok", 1.0), (1, "bad", 1.0), (2, "ok", 1.0), (185, "other", 1.0)])
    success = rows_of(t.success_rate(df, "ts", "kind", "ok", "bad"))
    assert [(r[0].hour, r[1], r[2]) for r in success] == [(10, 2, 1), (11, 0, 0), (12, 0, 0), (13, 0, 0)]
    assert [r[3] for r in success][1:] == [None, None, None]
    errors = rows_of(t.error_rate(df, "ts", "kind", "bad"))
    assert [(r[1], r[2]) for r in errors] == [(3, 1), (0, 0), (0, 0), (1, 0)]
    assert [round(r[3], 2) for r in errors] == [33.33, 0.0, 0.0, 0.0]


def test_rate_and_increase_use_aligned_windows(spark):
    df = frame(spark, [(0, "a", 1.0), (4, "a", 1.0), (5, "a", 1.0), (4, "b", 1.0)])
    rates = rows_of(t.event_rate(df, "ts", ["kind"]))
    assert [(r[0].minute, r[1], r[2], round(r[3] * 300)) for r in rates] == [(0, "a", 2, 2), (0, "b", 1, 1), (5, "a", 1, 1)]
    assert [(r.kind, r.increase) for r in t.increase_above(df, "ts", ["kind"], 1).collect()] == [("a", 2)]


def test_bands_include_their_limits(spark):
    df = spark.createDataFrame([(17.99,), (18.0,), (22.0,), (22.01,), (None,)], "p double")
    assert [r.band for r in t.banded(df, "p", 18, 22).collect()] == ["green", "yellow", "yellow", "red", None]


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(t.share_percent(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


def test_latest_value_per_series(spark):
    df = frame(spark, [(0, "a", 1.0), (9, "a", 5.0), (9, "a", 6.0), (3, "b", 2.0)])
    assert rows_of(t.latest_sum(df, ["kind"], ["ts", "event_id"], "value")) == [(2, 8.0)]


def test_label_pattern_matches_the_whole_label(spark):
    df = frame(spark, [(0, "err", 1.0), (0, "error", 1.0), (0, "terror", 1.0)])
    assert [r.kind for r in t.label_matches(df, "kind", "err|error").collect()] == ["err", "error"]


def test_uptime_counts_to_the_newest_sample(spark):
    df = frame(spark, [(0, "a", 1.0), (2, "a", 1.0), (3, "b", 1.0)])
    assert [(r[0], r[2]) for r in rows_of(t.uptime(df, "ts", ["kind"]))] == [("a", 180.0), ("b", 0.0)]


def test_first_matching_name_wins_and_others_are_dropped(spark):
    mappings = [
        t.NameMapping("job.done.*.*", "done_total", ("job", "state")),
        t.NameMapping("job.*.*.*", "other_total", ("event", "job", "state")),
        t.NameMapping("job.size", "job_size", ()),
    ]
    names = ["job.done.x.ok", "job.start.x.ok", "job.size", "job.done.x", "xjob.size", "jobbsize"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = t.name_labels(df, "name", mappings).select("name", "metric", "event", "job", "state")
    assert rows_of(found) == [
        ("job.done.x.ok", "done_total", None, "x", "ok"),
        ("job.size", "job_size", None, None, None),
        ("job.start.x.ok", "other_total", "start", "x", "ok"),
    ]

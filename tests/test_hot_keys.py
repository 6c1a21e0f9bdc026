"""Order-dependent operators against brute force, on data with a hot key."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import audit, dedup, ordered, profile, quantiles, telemetry
from tests.conftest import final_plan, rows_of

START = dt.datetime(2024, 1, 1)


def samples(n=3000, seed=7, keys=20):
    """Half of the rows belong to key 0, some to no key; many share a timestamp."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.5 else rng.choice([None, *range(1, keys)])
        # A burst: a third of all rows falls into one minute.
        second = rng.randrange(60) if rng.random() < 0.33 else rng.randrange(86400)
        rows.append((i, START + dt.timedelta(seconds=second), key, rng.choice("abc"), float(rng.randrange(50))))
    return rows


@pytest.fixture(scope="module")
def rows():
    return samples()


@pytest.fixture(scope="module")
def frame(spark, rows):
    schema = "event_id bigint, ts timestamp_ntz, k bigint, kind string, value double"
    return spark.createDataFrame(rows, schema).repartition(8).persist()


def by_key(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    return {k: sorted(g, key=lambda r: (r[1], r[0])) for k, g in groups.items()}


@pytest.mark.parametrize("n_slices", [2, 7, 64])
def test_running_sum(frame, rows, n_slices):
    sliced = ordered.with_slices(frame, ["k"], ["ts", "event_id"], n_slices)
    found = ordered.running_sum(sliced, ["k"], ["ts", "event_id"], F.col("value"), "total", total="whole")
    expected = []
    for group in by_key(rows).values():
        total, whole = 0.0, sum(r[4] for r in group)
        for row in group:
            total += row[4]
            expected.append((row[0], total, whole))
    assert rows_of(found.select("event_id", "total", "whole")) == sorted(expected, key=repr)


@pytest.mark.parametrize("n_slices", [2, 64])
def test_previous_row(frame, rows, n_slices):
    sliced = ordered.with_slices(frame, ["k"], ["ts", "event_id"], n_slices)
    found = ordered.previous_row(sliced, ["k"], ["ts", "event_id"], ["value", "event_id"])
    expected = []
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            before = group[i - 1] if i else (None,) * 5
            expected.append((row[0], before[4], before[0]))
    assert rows_of(found.select("event_id", "prev_value", "prev_event_id")) == sorted(expected, key=repr)


def test_sustained(frame, rows):
    found = telemetry.sustained(frame, "ts", ["k"], ["ts", "event_id"], F.col("kind") == "a", 30)
    expected = []
    for key, group in by_key(rows).items():
        for holds, run in groupby(group, key=lambda r: r[3] == "a"):
            run = list(run)
            seconds = (run[-1][1] - run[0][1]).total_seconds()
            if holds and seconds >= 30:
                expected.append((key, run[0][1], run[-1][1], len(run), seconds))
    assert expected
    assert rows_of(found.select("k", "run_start", "run_end", "run_rows", "seconds")) == sorted(expected, key=repr)


def test_null_keys_of_every_type_are_a_series_of_their_own(spark):
    data = [(i, None if i % 2 else "", None if i % 2 else dt.date(1970, 1, 1), None if i % 2 else 0.0) for i in range(40)]
    df = spark.createDataFrame(data, "n int, a string, b date, c double").withColumn("t", F.timestamp_seconds("n"))
    df = df.withColumn("t2", F.when(F.col("n") % 2 == 0, F.timestamp_seconds(F.lit(0))))
    keys = ["a", "b", "c", "t2"]
    found = ordered.running_sum(ordered.with_slices(df, keys, ["n"], 5), keys, ["n"], F.lit(1), "seen")
    assert rows_of(found.select("n", "seen")) == sorted(((n, n // 2 + 1) for n in range(40)), key=repr)
    with pytest.raises(TypeError, match="cannot be a series key"):
        ordered.join_keys(df.withColumn("x", F.array("n")), ["x"])


@pytest.mark.parametrize("n_slices", [2, 5, 16])
def test_missing_and_equal_times_make_no_difference(spark, n_slices):
    """Hot keys with NULL times, and one whose rows all have the same time, equal a plain window."""
    data = [(i, None if i % 9 == 0 else START + dt.timedelta(seconds=i % 50), 0, float(i % 7)) for i in range(300)]
    data += [(i, START, 1, float(i % 5)) for i in range(300, 600)] + [(i, None, i % 30, 1.0) for i in range(600, 660)]
    df = spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, k bigint, value double").repartition(5)
    order, plain = ["ts", "event_id"], df.withColumn(ordered.SLICE, F.lit(None).cast("int"))
    sliced = ordered.with_slices(df, ["k"], order, n_slices)
    if n_slices > 2:
        per_slice = sliced.where("k = 1").groupBy(ordered.SLICE).count().collect()
        assert len(per_slice) > 1  # one timestamp is no obstacle
    for operator in (
        lambda s: ordered.running_sum(s, ["k"], order, F.col("value"), "total", "whole").select("event_id", "total", "whole"),
        lambda s: ordered.previous_row(s, ["k"], order, ["value"]).select("event_id", "prev_value"),
        lambda s: ordered.runs(s, ["k"], order, F.col("value") < 4),
    ):
        assert rows_of(operator(sliced)) == rows_of(operator(plain))


def test_slices_split_a_hot_key_evenly(frame):
    sliced = ordered.with_slices(frame, ["k"], ["ts", "event_id"], 16)
    largest = sliced.where("k = 0").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest < frame.count() / 4


def test_ordinary_keys_need_no_slices(spark):
    even = spark.range(800).selectExpr("id AS event_id", "id % 80 AS k", "timestamp_micros(id) AS ts", "1 AS value")
    sliced = ordered.with_slices(even, ["k"], ["ts"], 8)
    found = ordered.running_sum(sliced, ["k"], ["ts"], F.col("value"), "total")
    plan = final_plan(found)
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert found.agg(F.max("total")).first()[0] == 10


@pytest.mark.parametrize("gap", [600, 3600])
def test_silence(frame, rows, gap):
    found = telemetry.silence(frame, "ts", ["k"], gap)
    expected = []
    for key, group in by_key(rows).items():
        for a, b in zip(group, group[1:]):
            seconds = (b[1] - a[1]).total_seconds()
            if seconds >= gap:
                expected.append((key, a[1], b[1], seconds))
    assert expected
    assert rows_of(found.select("k", "gap_start", "gap_end", "seconds")) == sorted(expected, key=repr)


def test_counter_reset_counts_the_new_value(spark):
    values = [5.0, 7.0, 3.0, 3.0, 10.0]
    data = [(i, START + dt.timedelta(seconds=i), "s", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, series string, value double")
    deltas = telemetry.counter_deltas(df, "ts", ["series"], ["ts", "event_id"], "value").orderBy("event_id")
    assert [r.delta for r in deltas.collect()] == [None, 2.0, 3.0, 0.0, 7.0]


def test_exact_quantiles(spark):
    rng = random.Random(3)
    groups = {
        "hot": [2.5] * 2000 + [rng.uniform(-5, 40) for _ in range(501)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 9) for _ in range(300)],
        "one": [7.0],
        "pair": [1.0, 2.0],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("nothing", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    levels = {"p10": 0.1, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    found = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", levels).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, p in levels.items():
            assert found[g][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-12)


def test_quantiles_rank_nan_last_as_percentile_does(spark):
    nan, inf = float("nan"), float("inf")
    data = [("a", v) for v in (1.0, 2.0, 3.0, nan, nan)] + [("b", v) for v in (-inf, inf, inf, 0.0)] + [("c", nan)]
    df = spark.createDataFrame(data, "g string, v double")
    found = quantiles.exact_quantiles(df, ["g"], "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    expected = df.groupBy("g").agg(*(F.percentile("v", p).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))))
    assert str(rows_of(found)) == str(rows_of(expected))


@pytest.mark.parametrize("span", [(1_000_000.0, 100.0), (0.0, 0.001), (-1e9, 2e9)])
def test_any_distribution_is_cut_into_even_ranges(spark, span):
    low, width = span
    values = spark.range(20_000).select((F.lit(low) + F.rand(3) * width).alias("v"))
    cut = ordered.cut(values, ["v"], 16)
    sizes = [r["count"] for r in cut.groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16


def test_moments_come_from_the_frequencies(spark):
    values = [1e9 + x for x in (1.0, 2.0, 2.0, 4.0, 8.5)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.numeric_summary(df).first()
    assert row.std == pytest.approx(np.std(values, ddof=1), rel=1e-9)
    assert (row.n, row.min_value, row.max_value) == (5, min(values), max(values))
    assert profile.numeric_summary(df.limit(1)).first().std is None


def test_numeric_summary_of_a_column_of_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    found = {r.column_name: r for r in profile.numeric_summary(df).collect()}
    assert (found["a"].n, found["a"].p50, found["a"].max_value) == (2, 2.0, 3.0)
    assert (found["b"].n, found["b"].p50) == (0, None)


def test_dedup_survivor_does_not_depend_on_the_input_order(spark):
    data = [(1, 5, None, "z"), (1, 5, 2, "b"), (1, 5, 1, "y"), (1, 4, 0, "a"), (2, 1, None, "n"), (2, None, 1, "m")]
    survivors = set()
    for seed in range(5):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, a int, b string").repartition(4)
        survivors.add(tuple(rows_of(dedup.dedup_latest(df, ["k"], ["t"], ["a", "b"]))))
    assert survivors == {((1, 5, 1, "y"), (2, 1, None, "n"))}
    with pytest.raises(ValueError):
        dedup.dedup_latest(df, ["k"])


def test_dedup_limits_groups_before_the_shuffle(frame):
    plan = final_plan(dedup.dedup_latest(frame, ["k"], ["ts"], ["event_id"]))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_distinct_on_key_equals_ranked_dedup(spark):
    from strata.operators.marts import fact_trips
    from strata.plans import trips
    from tests.conftest import SMALL

    raw = trips.raw_trips(spark, SMALL)
    assert rows_of(trips.trip_facts(raw)) == rows_of(fact_trips(trips.silver_trips(raw)))


def test_duplicate_rows_counts_surplus_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4), (3, 4), (3, 4)], "a int, b int")
    assert rows_of(dedup.duplicate_rows(df)) == [(6, 3, 3)]
    assert rows_of(dedup.duplicate_rows(df.limit(0))) == [(0, 0, 0)]


def test_key_audit(spark):
    good, other = "a" * 32, "b" * 32
    df = spark.createDataFrame([(good,), (good,), (other,), (None,), (None,), ("short",)], "id string")
    row = audit.key_audit(df, "id").first()
    assert (row.total_rows, row.null_keys, row.bad_length, row.distinct_keys, row.duplicates) == (6, 2, 1, 4, 2)
    empty = audit.key_audit(df.limit(0), "id").first()
    assert (empty.total_rows, empty.duplicates, empty.uniqueness_pct) == (0, 0, 0.0)


def test_value_counts_and_null_fraction(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, None)], "a int, b string")
    assert rows_of(profile.value_counts(df, ["a", "b"])) == [
        ("a", "1", 2), ("a", None, 1), ("b", "x", 1), ("b", None, 2),
    ]
    assert [(c, round(f, 3)) for c, f in rows_of(profile.null_fraction(df))] == [("a", 0.333), ("b", 0.667)]


def test_samples_and_distinct_values_are_stable(frame, rows):
    assert [r.event_id for r in profile.sample_rows(frame, ["event_id"], 3).collect()] == [0, 1, 2]
    assert [r.kind for r in profile.distinct_values(frame, "kind", limit=2).collect()] == ["a", "b"]
    assert profile.distinct_values(frame, "k").count() == len(by_key(rows))


@pytest.mark.parametrize("n_slices", [3, 100])
def test_boolean_and_binary_series_are_treated_alike_hot_or_not(spark, n_slices):
    df = spark.range(60).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 3 == 1).alias("flag"),
        F.when(F.col("id") % 2 == 0, F.encode(F.lit("x"), "utf-8")).alias("raw"),
    )
    keys = ["flag", "raw"]
    found = ordered.running_sum(ordered.with_slices(df, keys, ["n"], n_slices), keys, ["n"], F.lit(1), "seen")
    expected = [(n, 1 + sum(k % 6 == n % 6 for k in range(n))) for n in range(60)]
    assert rows_of(found.select("n", "seen")) == sorted(expected, key=repr)


def test_other_series_are_refused_before_anything_runs(spark):
    df = spark.range(10).select("id", F.array("id").alias("k"))
    with pytest.raises(TypeError, match="cannot be a series key"):
        ordered.with_slices(df, ["k"], ["id"], 100)

"""What the optimizer makes of the operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.config import DateRange
from strata.operators import marts, ordered
from strata.plans import trips as taxi
from strata.plans.queries import QUERIES
from strata.sources import readers, writers
from tests.conftest import SMALL, final_plan, rows_of


@pytest.fixture(scope="module")
def raw(spark):
    return taxi.raw_trips(spark, SMALL)


def test_rules_reach_the_scan(raw):
    scan = raw.where("fare_amount > 0")  # the scan line of a wide filter is cut in the plan text
    assert "GreaterThan(fare_amount,0.0)" in final_plan(scan)
    assert "PushedFilters: [IsNotNull(" in final_plan(taxi.trip_facts(raw))


def test_unused_columns_are_not_read(raw):
    plan = final_plan(marts.heatmap(taxi.trip_facts(raw)))
    read = plan[plan.index("FileScan parquet") :].split("]")[0]
    assert "store_and_fwd_flag" not in read
    assert "tpep_pickup_datetime" in read


def test_day_ranges_prune_partitions(spark, raw, folder):
    path = folder("landing")
    writers.split_by_day(raw, path, taxi.PICKUP, "date")
    chosen = readers.read_range(spark, path, "date", DateRange.of("2024-01-05", "2024-01-06"))
    plan = final_plan(chosen)
    assert "PartitionFilters: [isnotnull(date" in plan and "cast(date" not in plan
    assert len(chosen.inputFiles()) > 2
    found = chosen.select("_metadata.file_path").distinct().collect()
    assert {f.file_path.split("date=")[1][:10] for f in found} == {"2024-01-05", "2024-01-06"}


def test_top_zones_join_after_the_limit(raw, spark):
    plan = final_plan(marts.top_zones(taxi.trip_facts(raw), taxi.zones(spark, SMALL)))
    assert plan.index("BroadcastHashJoin") < plan.index("TakeOrderedAndProject")


def jobs_of(spark, build):
    """Jobs that building a query starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"build-{build.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build(spark, SMALL)
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


@pytest.mark.parametrize(
    "name", ["q_od_pairs", "q_kpi_sliced", "q_calendar_revenue", "q_top_zones", "q_dim_zone", "q_payment_share", "q_success_rate"]
)
def test_building_a_query_reads_no_data(spark, raw, name):
    plain = jobs_of(spark, QUERIES["q_rate_5m"])  # reads one schema
    assert jobs_of(spark, QUERIES[name]) <= 2 * max(plain, 1)


@pytest.mark.parametrize(
    ("name", "reads"),
    [("q_success_rate", 1), ("q_error_rate", 1), ("q_upsert", 3), ("q_numeric_summary", 3), ("q_uptime", 2), ("q_fare_outliers", 2)],
)
def test_inputs_are_read_once(spark, raw, name, reads):
    """Queries with more than one scan read what they wrote from one pass over the input, not the input."""
    plan = final_plan(QUERIES[name](spark, SMALL))
    assert plan.count("FileScan parquet") <= reads
    if reads > 1:
        assert "raw-trips" not in plan and "events.parquet" not in plan


def test_offsets_of_hot_keys_cost_no_further_shuffle_of_the_rows(spark):
    one_key = spark.range(1000).selectExpr("id AS event_id", "1 AS k", "timestamp_micros(id) AS ts", "id % 7 AS v")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        sliced = ordered.cut(one_key, ["k", "ts"], 8)
        plan = final_plan(ordered.running_sum(sliced, ["k"], ["ts"], F.col("v"), "total", all_sliced=True))
    finally:
        spark.conf.set(conf, before)
    rows_side = plan[plan.index("SortMergeJoin") :]
    rows_side = rows_side[: rows_side.index("FileScan")]
    assert rows_side.count("Exchange hashpartitioning") == 1
    assert "_slice" in rows_side[rows_side.index("Exchange hashpartitioning") :].splitlines()[0]


def test_raw_trips_are_written_without_a_shuffle(spark, folder, monkeypatch):
    """The derivation is one stage: tasks write the trips of the line items they read."""
    monkeypatch.setattr(taxi, "_RAW_TABLES", {})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("derive", "derive")
    try:
        taxi.raw_trips(spark, SMALL)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("derive")]
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    stages = [tracker.getStageInfo(s).name for j in jobs for s in j.stageIds]
    assert max(len(j.stageIds) for j in jobs) == 1 and not any("repartition" in s for s in stages)
    assert "Exchange" not in taxi.derive_trips(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(jobs) <= 3  # one schema each of line items and trips, and the write


def test_a_stray_file_is_not_read_by_one_task(spark, monkeypatch):
    """Whoever writes one file of a whole table must not read it in one task."""
    plans = []
    whole = writers_of(monkeypatch, plans)
    QUERIES["q_maintain"](spark, SMALL)
    stray = [p for p in whole if "Coalesce 1" in p]
    assert stray and all("Exchange" in p[p.index("Coalesce 1") :] for p in stray)


def writers_of(monkeypatch, plans):
    """Physical plans of all DataFrames whose ``write`` was asked for."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    write = Classic.write.fget

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(Classic, "write", property(noted))
    return plans


def test_the_pipeline_shuffles_a_days_rows_once(spark, raw, folder, monkeypatch):
    """Bronze, silver and fact are copied by day from files that are gathered already."""
    from strata.plans.pipeline import Layout, run_pipeline

    landing, plans, layout = folder("landing"), [], Layout(folder("lake"))
    writers.split_by_day(raw, landing, taxi.PICKUP, "date", taxi.TAXI.landing_from)
    writers_of(monkeypatch, plans)
    run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-01-01", "2024-01-12"), "run-0", marts=False)
    assert sum("REBALANCE" in p for p in plans) == 2  # the increment, and the small daily summary
    run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-01-10", "2024-01-20"), "run-1", marts=False)
    silver, fact = (spark.read.parquet(layout.path(t)) for t in ("silver", "fact_trips"))
    expected = taxi.silver_trips(raw).where("pickup_date BETWEEN '2024-01-01' AND '2024-01-20'")
    columns = sorted(expected.columns)
    assert rows_of(silver.select(columns)) == rows_of(expected.select(columns))
    assert fact.count() == silver.count()


def test_keys_added_after_the_dedup_are_those_added_before(spark, raw):
    """Text columns may be NULL or hold the separator, so only their key tells such rows apart."""
    from dataclasses import replace

    from strata.functions.features import add_trip_features
    from strata.operators.dedup import dedup_latest

    early = add_trip_features(dedup_latest(taxi._keyed(raw, taxi.TAXI), ["trip_id"], (), taxi.TIE_BREAK))
    for found in (taxi.silver_trips(raw), taxi.silver_trips(raw, gathered_by="pickup_date").select(*early.columns)):
        assert found.columns == early.columns and rows_of(found) == rows_of(early)
    spec = replace(taxi.TAXI, key_columns=(*taxi.KEY_COLUMNS, "store_and_fwd_flag"))
    holes = raw.withColumn("store_and_fwd_flag", F.expr("if(VendorID = 1, if(PULocationID % 2 = 0, NULL, ''), 'N')"))
    both = holes.unionByName(holes.withColumn("store_and_fwd_flag", F.expr("coalesce(store_and_fwd_flag, '')")))
    keys = taxi.silver_trips(both, spec).select("trip_id")
    assert keys.count() == keys.distinct().count() == taxi._keyed(both, spec).select("trip_id").distinct().count()


def test_rows_outside_of_partitions(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, day string")
    for named in ([("a",)], [("a",), (None,)], []):
        touched = spark.createDataFrame(named, "day string")
        inside = rows_of(readers.in_partitions(rows, "day", touched))
        outside = rows_of(readers.in_partitions(rows, "day", touched, others=True))
        assert sorted(inside + outside, key=repr) == [(1, "a"), (2, "b"), (3, None)] and len(inside) == len(named)

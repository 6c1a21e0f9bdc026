from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.config import DateRange
from strata.operators.audit import increment_checks
from strata.plans import trips as taxi
from strata.plans.pipeline import Layout, run_pipeline
from strata.sources import files, maintenance, publish, writers
from tests.conftest import SMALL, rows_of

DAY = dt.date(2024, 1, 1)
NOW = dt.datetime(2024, 6, 1)


def table(spark, ids, day=0, amount=1.0):
    data = [(i, DAY + dt.timedelta(days=day), amount) for i in ids]
    return spark.createDataFrame(data, "id string, day date, amount double")


def test_publish_and_refuse(spark, folder):
    root = folder("wap")
    path, log = f"{root}/t", f"{root}/log"
    checks = increment_checks("amount", "id")
    good = publish.publish(table(spark, "ab"), path, ["day"], checks, "r1", log)
    assert good.published and not files.path_exists(spark, good.staged_path)
    doubled = publish.publish(table(spark, "aa"), path, ["day"], checks, "r2", log)
    empty = publish.publish(table(spark, "a").limit(0), path, ["day"], checks, "r3", log)
    assert doubled.audit == {"has_rows": True, "no_null_amount": True, "unique_id": False}
    assert not empty.published and not empty.audit["has_rows"]
    assert files.path_exists(spark, doubled.staged_path)
    assert spark.read.parquet(path).count() == 2
    entries = spark.read.parquet(log).orderBy("run_id").select("run_id", "published", "rows", "files")
    assert [tuple(r) for r in entries.collect()] == [("r1", True, 2, 1), ("r2", False, 2, 1), ("r3", False, 0, 0)]


def test_failure_removes_the_staged_copy(spark, folder):
    path = folder("wap") + "/t"
    with pytest.raises(Exception, match="no_such_column"):
        publish.publish(table(spark, "ab"), path, ["day"], {"bad": F.count("no_such_column") > 0}, "r1")
    assert not files.path_exists(spark, f"{path}_staging/r1")


def test_pipeline_is_idempotent(spark, folder):
    layout, landing = Layout(folder("lake")), folder("landing")
    writers.split_by_day(taxi.raw_trips(spark, SMALL), landing, taxi.PICKUP, "date", taxi.TAXI.landing_from)
    days = DateRange.of("2024-01-03", "2024-01-05")
    first = run_pipeline(spark, taxi.TAXI, layout, landing, days, "a")
    tables = ("silver", "fact_trips", "agg_daily_summary")
    before = {t: rows_of(spark.read.parquet(layout.path(t))) for t in tables}
    again = run_pipeline(spark, taxi.TAXI, layout, landing, days, "b")
    assert first.published and again.published
    assert (first.bronze.ingested_days, again.bronze.ingested_days) == (3, 0)
    assert {t: rows_of(spark.read.parquet(layout.path(t))) for t in tables} == before
    run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-01-05", "2024-01-07"), "c")
    assert spark.read.parquet(layout.path("fact_trips")).select("pickup_date").distinct().count() == 5
    assert not run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2030-01-01"), "d").published


def test_pipeline_keeps_days_that_grow_later(spark, folder):
    """Trips picked up on 3 January that land on the 5th join what the 3rd holds already."""
    layout, landing = Layout(folder("lake")), folder("landing")
    raw = taxi.raw_trips(spark, SMALL).where("tpep_pickup_datetime >= '2024-01-03' AND tpep_pickup_datetime < '2024-01-04'")
    late = F.col("PULocationID") % 2 == 0
    day = F.when(late, F.lit(dt.date(2024, 1, 5))).otherwise(F.lit(dt.date(2024, 1, 3)))
    writers.replace_partitions(raw.withColumn("date", day), landing, ["date"])
    none = run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-02-01"), "none")
    assert (none.published, none.bronze.skipped_days) == (False, 1)
    run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-01-03"), "a")
    early = spark.read.parquet(layout.path("silver")).count()
    run_pipeline(spark, taxi.TAXI, layout, landing, DateRange.of("2024-01-05"), "b")
    expected = taxi.silver_trips(raw).count()
    assert 0 < early < expected
    for table in ("silver", "fact_trips"):
        assert spark.read.parquet(layout.path(table)).count() == expected
    assert spark.read.parquet(layout.path("agg_daily_summary")).first().total_trips == expected


def test_manifest_grows_with_what_runs_touch(spark, folder):
    spec = published(spark, folder, 6)
    assert publish.read_manifest(spark, spec.manifest_path).count() == 6
    assert files.file_inventory(spark, spec.path).count() == 6


def test_a_repeated_run_has_one_log_entry(spark, folder):
    spec = published(spark, folder, 1)
    for amount in (2.0, 3.0):
        publish.publish(table(spark, "ab", amount=amount), spec.path, ["day"], {}, "again", spec.log_path, spec.manifest_path)
    log = publish.read_log(spark, spec.log_path)
    assert rows_of(log.groupBy("run_id").count()) == [("again", 1), ("run-00", 1)]


def test_files_of_expired_runs_that_are_still_read_are_no_orphans(spark, folder):
    spec = published(spark, folder, 5)
    done = {r.step: r.items for r in maintenance.maintain(spark, [spec], "monthly", as_of=NOW, retain_last=1).collect()}
    assert done == {"expire": 4, "orphans": 0}
    assert spark.read.parquet(spec.path).count() == 10
    again = {r.step: r.items for r in maintenance.maintain(spark, [spec], "monthly", as_of=NOW, retain_last=1).collect()}
    assert again == {"expire": 0, "orphans": 0}


def test_tables_sharing_a_log_do_not_meet(spark, folder):
    one, other = published(spark, folder, 3), published(spark, folder, 3)
    shared = maintenance.MaintainedTable(other.path, other.partition_columns, one.log_path, one.manifest_path)
    publish.publish(table(spark, "z", day=9), other.path, ["day"], {}, "run-00", one.log_path, one.manifest_path, NOW)
    maintenance.maintain(spark, [one], "monthly", as_of=NOW, retain_last=1)
    log = publish.read_log(spark, one.log_path)
    assert rows_of(log.select("table_path", "run_id")) == sorted([(one.path, "run-02"), (shared.path, "run-00")])


def test_errors_without_text_and_tables_without_log_stop_nothing(spark, folder, monkeypatch):
    good, bare = published(spark, folder, 1), maintenance.MaintainedTable(scattered(spark, folder), ("day",))
    unpublished = maintenance.MaintainedTable(scattered(spark, folder), ("day",), good.log_path, good.manifest_path)
    before = rows_of(files.file_inventory(spark, unpublished.path).select("path"))
    done = {(r.step, r.table_path): r for r in maintenance.maintain(spark, [bare, unpublished, good], as_of=NOW).collect()}
    assert done["compact", bare.path].ok and not done["expire", bare.path].ok
    assert not done["compact", unpublished.path].ok
    assert rows_of(files.file_inventory(spark, unpublished.path).select("path")) == before  # nothing was rewritten
    assert all(done[step, good.path].ok for step in ("compact", "expire", "orphans"))

    def broken(*_):
        raise RuntimeError

    monkeypatch.setattr(maintenance, "compact", broken)
    found = {r.table_path: r for r in maintenance.maintain(spark, [bare, good], "weekly", as_of=NOW).collect()}
    assert {r.detail for r in found.values()} == {"RuntimeError"}


def test_only_old_orphans_and_old_refused_copies_are_removed(spark, folder):
    spec = published(spark, folder, 2)
    publish.publish(table(spark, "q"), spec.path, ["day"], {"never": F.count(F.lit(1)) < 0}, "refused", spec.log_path)
    stray = table(spark, "xyz").drop("day").coalesce(1)
    stray.write.mode("append").parquet(f"{spec.path}/day=2024-01-01")
    staged, now = f"{spec.path}_staging/refused", dt.datetime.now(dt.timezone.utc)

    def orphans(as_of):
        return maintenance.maintain(spark, [spec], "full", ["compact", "expire"], as_of, remove_after_days=3).first().items

    assert orphans(now) == 1 and files.path_exists(spark, staged)
    assert orphans(now + dt.timedelta(days=9)) == 1 and not files.path_exists(spark, staged)
    assert orphans(now) == 0 and spark.read.parquet(spec.path).count() == 4


def scattered(spark, folder):
    path = folder("small-files")
    rows = spark.range(4000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5).cast("int").alias("day"),
        F.concat(F.lit("text"), F.col("id")).alias("note"),
    )
    rows.repartition(8).write.partitionBy("day").parquet(path)
    return path


def test_compaction_keeps_every_row(spark, folder):
    path = scattered(spark, folder)
    before = rows_of(spark.read.parquet(path))
    report = maintenance.compact(spark, path, ["day"]).collect()
    assert rows_of(spark.read.parquet(path)) == before
    assert {(r.files_before, r.files_after) for r in report} == {(8, 1)}


def test_compaction_reaches_the_null_partition(spark, folder):
    path = folder("small-files")
    rows = spark.range(900).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("day"))
    rows.repartition(6).write.partitionBy("day").parquet(path)
    before = rows_of(spark.read.parquet(path))
    report = {r.day: (r.files_before, r.files_after) for r in maintenance.compact(spark, path, ["day"]).collect()}
    assert report == {None: (6, 1), 1: (6, 1), 2: (6, 1)}
    assert rows_of(spark.read.parquet(path)) == before


def test_compaction_splits_a_large_partition(spark, folder):
    path = scattered(spark, folder)
    before = rows_of(spark.read.parquet(path))
    plan = {r.day: r for r in maintenance.compaction_plan(spark, path, ["day"]).collect()}
    target = plan[0].bytes // 2  # day 0 holds almost half of the rows and needs two files, the others one
    report = {r.day: r for r in maintenance.compact(spark, path, ["day"], target).collect()}
    assert rows_of(spark.read.parquet(path)) == before
    assert 2 <= report[0].files_after <= 3
    assert {r.files_after for day, r in report.items() if day} == {1}


def test_compaction_leaves_good_partitions_alone(spark, folder):
    path = scattered(spark, folder)
    maintenance.compact(spark, path, ["day"])
    listed = rows_of(files.file_inventory(spark, path).select("path", "modificationTime"))
    maintenance.compact(spark, path, ["day"])
    assert rows_of(files.file_inventory(spark, path).select("path", "modificationTime")) == listed


def test_expiry_needs_age_and_newer_versions(spark):
    ages = {"busy": range(0, 100, 5), "idle": range(100, 112)}
    data = [(t, f"{t}-{a:03d}", NOW - dt.timedelta(days=a)) for t, days in ages.items() for a in days]
    log = spark.createDataFrame(data, "table_path string, run_id string, committed_at timestamp")
    found = maintenance.expire_candidates(log, F.lit(NOW), days_to_keep=30, retain_last=10)
    assert [r[1] for r in rows_of(found)] == [f"busy-{a:03d}" for a in range(50, 100, 5)] + ["idle-110", "idle-111"]
    kept_by_age = maintenance.expire_candidates(log, F.lit(NOW), days_to_keep=30, retain_last=1)
    assert min(r[1] for r in rows_of(kept_by_age)) == "busy-035"


def test_orphans_with_a_hot_reference(spark):
    inventory = spark.createDataFrame([(c,) for c in "abcd"], "path string")
    manifest = spark.createDataFrame([("a",)] * 500 + [("c",)], "path string")
    assert rows_of(maintenance.orphans(inventory, manifest)) == [("b",), ("d",)]


def published(spark, folder, runs):
    root = folder("lake")
    spec = maintenance.MaintainedTable(f"{root}/t", ("day",), f"{root}/log", f"{root}/manifest")
    for i in range(runs):
        publish.publish(
            table(spark, "ab", day=i), spec.path, ["day"], {"has_rows": F.count(F.lit(1)) > 0}, f"run-{i:02d}",
            spec.log_path, spec.manifest_path, committed_at=NOW - dt.timedelta(days=100 - i),
        )
    return spec


def test_maintenance_steps_and_isolation(spark, folder):
    good = published(spark, folder, 4)
    broken = maintenance.MaintainedTable(folder("nothing"), ("day",), folder("nothing"), folder("nothing"))
    spark.range(3).coalesce(1).withColumn("day", F.lit(DAY)).write.mode("append").partitionBy("day").parquet(good.path)
    full = maintenance.maintain(spark, [broken, good], "full", as_of=NOW, retain_last=2, skip=["compact"])
    results = {(r.step, r.table_path): r for r in full.collect()}
    assert not results["expire", broken.path].ok and results["expire", broken.path].detail
    assert results["expire", good.path].items == 2
    assert results["orphans", good.path].items == 1
    assert rows_of(publish.read_log(spark, good.log_path).select("run_id")) == [("run-02",), ("run-03",)]
    manifest = publish.read_manifest(spark, good.manifest_path)
    assert rows_of(manifest.groupBy("run_id").count()) == [("run-02", 1), ("run-03", 3)]


def test_compacted_files_are_no_orphans(spark, folder):
    spec = published(spark, folder, 2)
    table(spark, [str(i) for i in range(50)], day=1).repartition(5).write.mode("append").partitionBy("day").parquet(spec.path)
    publish.record_manifest(spark, spec.path, "run-01", spec.manifest_path)
    done = {r.step: r.items for r in maintenance.maintain(spark, [spec], as_of=NOW, retain_last=5).collect()}
    assert done == {"compact": 1, "expire": 0, "orphans": 0}


def test_the_visible_run_outlives_failed_ones(spark, folder):
    spec = published(spark, folder, 1)
    for i in range(3):
        refused = {"never": F.count(F.lit(1)) < 0}
        publish.publish(table(spark, "c"), spec.path, ["day"], refused, f"refused-{i}", spec.log_path, spec.manifest_path, NOW)
    done = {r.step: r for r in maintenance.maintain(spark, [spec], "monthly", as_of=NOW, retain_last=2).collect()}
    assert (done["expire"].items, done["orphans"].items) == (0, 0)


def test_maintenance_modes(spark, folder):
    spec = published(spark, folder, 1)

    def steps(**options):
        return [r.step for r in maintenance.maintain(spark, [spec], as_of=NOW, **options).collect()]

    assert steps(mode="weekly") == ["compact"]
    assert steps(mode="monthly") == ["expire", "orphans"]
    assert steps() == ["compact", "expire", "orphans"]
    assert steps(skip=["expire"]) == ["compact", "orphans"]

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import telemetry
from strata.plans import trips as taxi
from strata.plans.queries import QUERIES
from strata.sources import evolution, key_index, writers
from strata.sources.contracts import RAW_TRIP, contract
from strata.sources.readers import in_partitions
from strata.streaming import ingest, silver
from tests.conftest import SMALL, final_plan, rows_of

DAY = dt.date(2024, 1, 1)


def files_of(path):
    root = path.removeprefix("file://")
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(root) for f in names}


DECLARED = contract(id="long", amount="double", note="string", day="date")


def versions(spark, path):
    old = spark.createDataFrame([(1, 1.5, DAY), (2, None, DAY)], "id int, amount float, day date")
    new = spark.createDataFrame([(3 << 40, 2.5, "n", DAY + dt.timedelta(days=1))], DECLARED)
    writers.replace_partitions(old, path, ["day"])
    writers.replace_partitions(new, path, ["day"])


def test_old_and_new_files_are_read_under_one_schema(spark, folder):
    path = folder("evolved")
    versions(spark, path)
    before = files_of(path)
    evolution.require_readable(spark, path, DECLARED)
    table = evolution.read_under(spark, path, DECLARED, {"note": lambda df: F.concat(F.lit("#"), "id")})
    assert rows_of(table) == rows_of(spark.createDataFrame([(1, 1.5, "#1", DAY), (2, None, "#2", DAY), (3 << 40, 2.5, "n", DAY + dt.timedelta(days=1))], DECLARED))
    assert files_of(path) == before
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)" in final_plan(table.where("id > 5"))


def test_changes_that_lose_something_are_refused(spark, folder):
    path = folder("broken")
    versions(spark, path)
    for declared in (contract(amount="double", note="string", day="date"), contract(id="integer", amount="double", note="string", day="date"), contract(id="long", amount="string", note="string", day="date")):
        with pytest.raises(ValueError, match="cannot be read"):
            evolution.require_readable(spark, path, declared)
    wide = T.StructType([*DECLARED.fields, T.StructField("more", T.StringType())])
    assert evolution.broken_promises(DECLARED, wide) == []


# --- key index


def keyed(spark, n=200, days=20):
    return spark.createDataFrame([(f"k{k:04d}", DAY + dt.timedelta(days=k % days), 1.0) for k in range(n)], "id string, day date, amount double")


def read_files(df):
    """Data files that a query opens."""
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_an_indexed_upsert_reads_only_partitions_that_may_match(spark, folder, monkeypatch):
    path = folder("indexed")
    writers.replace_partitions(keyed(spark), path, ["day"])
    key_index.index_keys(spark, path, f"{path}_keys", ["id"], "day")
    searched = []

    def noted(df, column, touched):
        found = in_partitions(df, column, touched)
        searched.append(read_files(found))
        return found

    monkeypatch.setattr(writers, "in_partitions", noted)
    moved = spark.createDataFrame([("k0003", DAY + dt.timedelta(days=25), 9.0), ("new", DAY, 9.0)], "id string, day date, amount double")
    writers.upsert_into(spark, path, moved, ["id"], "day", key_fixes_partition=False, index_path=f"{path}_keys")
    assert len(searched[0]) <= 2  # of 20
    expected = {r.id: (r.day, r.amount) for r in keyed(spark).collect()} | {"k0003": (DAY + dt.timedelta(days=25), 9.0), "new": (DAY, 9.0)}
    assert {r.id: (r.day, r.amount) for r in spark.read.parquet(path).collect()} == expected
    # The index was kept up: the key is now found in its new partition alone.
    again = spark.createDataFrame([("k0003", DAY, 7.0)], "id string, day date, amount double")
    found = key_index.may_hold(spark, path, f"{path}_keys", again, ["id"], "day")
    assert [r.day for r in found.collect()] == [DAY + dt.timedelta(days=25)]


def test_entries_of_changed_files_count_for_nothing(spark, folder):
    path = folder("stale")
    writers.replace_partitions(keyed(spark), path, ["day"])
    key_index.index_keys(spark, path, f"{path}_keys", ["id"], "day")
    other = spark.createDataFrame([("secret", DAY + dt.timedelta(days=4), 1.0)], "id string, day date, amount double")
    writers.replace_partitions(other, path, ["day"])  # by a writer that knows no index
    found = key_index.may_hold(spark, path, f"{path}_keys", other, ["id"], "day")
    assert [r.day for r in found.collect()] == [DAY + dt.timedelta(days=4)]
    assert key_index.may_hold(spark, path, folder("none"), other, ["id"], "day").count() == 20


@pytest.mark.parametrize("indexed", [False, True])
def test_upserts_with_and_without_an_index_agree(spark, folder, indexed):
    path = folder("agree")
    index = f"{path}_keys" if indexed else None
    nulls = spark.createDataFrame([("n1", None, 1.0), (None, DAY, 1.0)], "id string, day date, amount double")
    writers.upsert_into(spark, path, keyed(spark).unionByName(nulls), ["id"], "day", key_fixes_partition=False, index_path=index)
    source = spark.createDataFrame([("n1", DAY, 5.0), ("k0007", None, 6.0), (None, DAY, 7.0)], "id string, day date, amount double")
    writers.upsert_into(spark, path, source, ["id"], "day", key_fixes_partition=False, index_path=index)
    found = {(r.id, r.day, r.amount) for r in spark.read.parquet(path).collect()}
    expected = {(r.id, r.day, r.amount) for r in keyed(spark).collect() if r.id != "k0007"}
    assert found == expected | {("n1", DAY, 5.0), ("k0007", None, 6.0), (None, DAY, 1.0), (None, DAY, 7.0)}


# --- counts while writing


def test_rows_are_counted_while_they_are_written(spark, folder):
    path = folder("counted")
    writers.replace_partitions(keyed(spark, 60), path, ["day"])
    assert writers.replace_partitions_counted(keyed(spark, 130, 3), path, ["day"]) == (130, 130)
    assert writers.replace_partitions_counted(keyed(spark, 5).limit(0), path, ["day"]) == (0, 0)


# --- names


def test_a_thousand_mappings_make_one_plan_without_patterns(spark):
    mappings = [telemetry.NameMapping(f"svc{k}.*.{'done' if k % 2 else '*'}", f"m{k}", ("host", "state") if k % 2 == 0 else ("host",)) for k in range(1000)]
    mappings += [telemetry.NameMapping("*.*.*", "any", ("a", "b", "c")), telemetry.NameMapping("svc5.*.*", "late", ("host", "state"))]
    names = [(f"svc{k}.h{k}.{s}",) for k in range(0, 1100, 37) for s in ("done", "open")] + [("svc5.h.open",), ("a.b",), ("a..c",), (None,), ("svc4..x",)]
    df = spark.createDataFrame(names, "name string")
    started = time.perf_counter()
    found = telemetry.name_labels(df, "name", mappings)
    rows = {r.name: r for r in found.collect()}
    assert time.perf_counter() - started < 60
    plan = final_plan(found)
    assert "RLIKE" not in plan and "regexp_extract" not in plan
    for (name,) in names:
        expected = slow_labels(name, mappings)
        assert (name in rows) == (expected is not None)
        if expected:
            assert {k: v for k, v in rows[name].asDict().items() if v is not None and k != "name"} == expected


def slow_labels(name, mappings):
    for m in mappings:
        parts, wanted = (name or "").split("."), m.pattern.split(".")
        if name is not None and len(parts) == len(wanted) and all(w == p or (w == "*" and p) for w, p in zip(wanted, parts)):
            return {"metric": m.metric, **dict(zip(m.labels, (p for w, p in zip(wanted, parts) if w == "*")))}
    return None


def test_a_glob_inside_a_part_is_refused(spark):
    with pytest.raises(ValueError, match="not a part of its own"):
        telemetry.name_labels(spark.createDataFrame([("a",)], "name string"), "name", [telemetry.NameMapping("a.b*", "m", ("x",))])


# --- silver stream


def test_late_copies_go_and_state_stays_bounded(spark, folder):
    """Days arrive one by one, each with copies of the day before; keys older than the watermark leave the state."""
    landing, root = folder("landing"), folder("stream")
    raw = taxi.raw_trips(spark, SMALL).where("tpep_pickup_datetime >= '2024-01-02' AND tpep_pickup_datetime < '2024-01-12'")
    day = F.to_date(taxi.PICKUP)
    for n in range(2, 12):
        own, before = raw.where(day == dt.date(2024, 1, n)), raw.where(day == dt.date(2024, 1, n - 1))
        landed = own.unionByName(before).withColumn("date", F.lit(dt.date(2024, 1, n)))
        writers.replace_partitions(landed.coalesce(1), landing, ["date"])
        stream = ingest.stream_landing(spark, landing, RAW_TRIP).drop("date")
        query = (
            silver.silver_stream(stream, taxi.TAXI, "2 days").writeStream.format("parquet").outputMode("append")
            .option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    found = spark.read.parquet(f"{root}/table")
    assert found.count() == found.select("trip_id").distinct().count()
    columns = ["trip_id", "pickup_date", "fare_amount", "trip_duration_min"]
    assert rows_of(found.select(*columns)) == rows_of(taxi.silver_trips(raw).select(*columns))
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 0.6 * found.count()


@pytest.mark.parametrize("name", ["q_stream_silver", "q_evolved_schema", "q_upsert_indexed"])
def test_queries_have_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 100

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.config import DateRange
from strata.functions.keys import record_key
from strata.operators.upsert import upsert
from strata.sources import catalog, files, readers, writers
from tests.conftest import rows_of

DAY = dt.date(2024, 1, 1)


def trips(spark, rows):
    """(id, day number, amount)"""
    data = [(i, DAY + dt.timedelta(days=d), a) for i, d, a in rows]
    return spark.createDataFrame(data, "id string, day date, amount double")


def content(spark, path):
    return [(r.id, (r.day - DAY).days, r.amount) for r in spark.read.parquet(path).orderBy("id", "day").collect()]


def test_replace_touches_only_named_partitions(spark, folder):
    path = folder()
    writers.replace_partitions(trips(spark, [("a", 0, 1.0), ("b", 1, 1.0), ("c", 1, 1.0)]), path, ["day"])
    writers.replace_partitions(trips(spark, [("d", 1, 2.0), ("e", 2, 2.0)]), path, ["day"])
    assert content(spark, path) == [("a", 0, 1.0), ("d", 1, 2.0), ("e", 2, 2.0)]


def test_one_file_per_small_partition(spark, folder):
    path = folder()
    df = trips(spark, [(str(i), i % 3, 1.0) for i in range(300)]).repartition(8)
    writers.replace_partitions(df, path, ["day"])
    assert files.file_inventory(spark, path).count() == 3


def test_a_hot_partition_is_written_by_several_tasks(spark, folder):
    path, conf = folder(), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "64KB")
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("day"), F.rand(1).alias("x")
        )
        writers.replace_partitions(rows, path, ["day"])
    finally:
        spark.conf.set(conf, before)
    files_per_day = dict(rows_of(files.file_inventory(spark, path).groupBy("day").count()))
    assert files_per_day[0] >= 4 and spark.read.parquet(path).count() == 60000


def test_write_once_keeps_the_first_table(spark, folder):
    path = folder()
    writers.write_once(trips(spark, [("a", 0, 1.0)]), path)
    writers.write_once(trips(spark, [("b", 0, 1.0)]), path)
    assert content(spark, path) == [("a", 0, 1.0)]


def test_rewrite_may_read_its_own_table(spark, folder):
    path = folder()
    trips(spark, [("a", 0, 1.0), ("b", 0, 2.0)]).write.parquet(path)
    backup = folder("backup")
    writers.rewrite_table(spark.read.parquet(path).withColumn("amount", F.col("amount") * 2), path, backup)
    assert content(spark, path) == [("a", 0, 2.0), ("b", 0, 4.0)]
    assert content(spark, backup) == [("a", 0, 1.0), ("b", 0, 2.0)]


@pytest.mark.parametrize("key_fixes_partition", [True, False])
def test_upsert_into_table_twice_equals_once(spark, folder, key_fixes_partition):
    path = folder()
    writers.upsert_into(spark, path, trips(spark, [("a", 0, 1.0), ("b", 0, 1.0), ("c", 1, 1.0)]), ["id"], "day")
    new = trips(spark, [("b", 0, 9.0), ("d", 3, 9.0)])
    for _ in range(2):
        writers.upsert_into(spark, path, new, ["id"], "day", key_fixes_partition)
        assert content(spark, path) == [("a", 0, 1.0), ("b", 0, 9.0), ("c", 1, 1.0), ("d", 3, 9.0)]


@pytest.mark.parametrize("key_fixes_partition", [True, False])
def test_upsert_of_nothing_changes_nothing(spark, folder, key_fixes_partition):
    path = folder()
    writers.replace_partitions(trips(spark, [("a", 0, 1.0)]), path, ["day"])
    nothing = trips(spark, [("a", 0, 2.0)]).where("amount > 5")
    writers.upsert_into(spark, path, nothing, ["id"], "day", key_fixes_partition)
    assert content(spark, path) == [("a", 0, 1.0)]


def test_upsert_refuses_a_source_that_repeats_a_key(spark, folder):
    path = folder()
    writers.replace_partitions(trips(spark, [("a", 0, 1.0)]), path, ["day"])
    with pytest.raises(ValueError, match="repeats a key"):
        writers.upsert_into(spark, path, trips(spark, [("b", 0, 1.0), ("b", 0, 2.0)]), ["id"], "day")
    writers.upsert_into(spark, path, trips(spark, [(None, 0, 3.0), (None, 0, 4.0)]), ["id"], "day")
    assert [r[2] for r in content(spark, path)] == [3.0, 4.0, 1.0]


def test_key_that_changes_its_partition_leaves_no_copy(spark, folder):
    path = folder()
    writers.replace_partitions(trips(spark, [("a", 0, 1.0), ("b", 1, 1.0)]), path, ["day"])
    writers.upsert_into(spark, path, trips(spark, [("a", 1, 5.0)]), ["id"], "day", key_fixes_partition=False)
    assert content(spark, path) == [("a", 1, 5.0), ("b", 1, 1.0)]


def test_partition_that_loses_its_last_key_disappears(spark, folder):
    path = folder()
    writers.replace_partitions(trips(spark, [("a", 0, 1.0), ("b", 1, 1.0), ("c", 2, 1.0)]), path, ["day"])
    new = trips(spark, [("a", 2, 5.0), ("x", 7, 5.0)])
    writers.upsert_into(spark, path, new, ["id"], "day", key_fixes_partition=False)
    assert content(spark, path) == [("a", 2, 5.0), ("b", 1, 1.0), ("c", 2, 1.0), ("x", 7, 5.0)]


def parts(spark, rows):
    """(id, day number or None, amount)"""
    data = [(i, None if d is None else DAY + dt.timedelta(days=d), a) for i, d, a in rows]
    return spark.createDataFrame(data, "id string, day date, amount double")


@pytest.mark.parametrize("key_fixes_partition", [True, False])
def test_the_null_partition_is_upserted_like_any_other(spark, folder, key_fixes_partition):
    path = folder()
    writers.replace_partitions(parts(spark, [("1", 0, 1.0), ("2", None, 1.0), ("3", None, 1.0)]), path, ["day"])
    writers.upsert_into(spark, path, parts(spark, [("2", None, 5.0)]), ["id"], "day", key_fixes_partition)
    found = [(r.id, r.day is None, r.amount) for r in spark.read.parquet(path).orderBy("id").collect()]
    assert found == [("1", False, 1.0), ("2", True, 5.0), ("3", True, 1.0)]


def test_a_null_partition_that_loses_its_last_key_disappears(spark, folder):
    path = folder()
    writers.replace_partitions(parts(spark, [("a", None, 1.0), ("b", 1, 1.0)]), path, ["day"])
    writers.upsert_into(spark, path, parts(spark, [("a", 1, 5.0)]), ["id"], "day", key_fixes_partition=False)
    assert content(spark, path) == [("a", 1, 5.0), ("b", 1, 1.0)]


def test_partition_names_with_special_signs(spark, folder):
    path, names = folder(), ["a b", "c/d", "e=f", "007", "ü%20"]
    rows = [(str(i), n, 1.0) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id string, place string, amount double")
    writers.upsert_into(spark, path, df, ["id"], "place")
    moved = spark.createDataFrame([("0", "007", 2.0), ("1", "c/d", 2.0)], df.schema)
    writers.upsert_into(spark, path, moved, ["id"], "place", key_fixes_partition=False)
    found = spark.read.schema(df.schema).parquet(path)
    assert rows_of(found.select("id", "place", "amount")) == [
        ("0", "007", 2.0), ("1", "c/d", 2.0), ("2", "e=f", 1.0), ("3", "007", 1.0), ("4", "ü%20", 1.0),
    ]


def test_the_first_upsert_refuses_repeated_keys_too(spark, folder):
    path = folder()
    with pytest.raises(ValueError, match="repeats a key"):
        writers.upsert_into(spark, path, trips(spark, [("b", 0, 1.0), ("b", 0, 2.0)]), ["id"], "day")
    assert not files.path_exists(spark, path)


def test_backfill_fills_the_null_partition(spark, folder):
    path = folder()
    writers.replace_partitions(parts(spark, [(None, None, 1.0), ("x", 0, 2.0), (None, 0, 3.0)]), path, ["day"])
    assert writers.backfill_column(spark, path, "id", lambda df: F.lit("filled"), "day") == 2
    assert spark.read.parquet(path).where("id IS NULL").count() == 0
    assert spark.read.parquet(path).count() == 3


def test_an_interrupted_move_is_completed_by_the_next(spark, folder):
    path, staged = folder("table"), folder("staged")
    writers.replace_partitions(trips(spark, [("a", 0, 1.0), ("b", 1, 1.0)]), path, ["day"])
    writers.stage(trips(spark, [("a", 0, 2.0), ("b", 1, 2.0)]), staged, ["day"])
    first = files.leaf_directories(spark, staged)[0]
    make, system = spark._jvm.org.apache.hadoop.fs.Path, None
    system = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(make(f"{path}/_replaced"))
    system.rename(make(f"{path}/{first}"), make(f"{path}/_replaced/{first}"))  # and then the job died
    assert content(spark, path) == [("b", 1, 1.0)]
    assert writers.promote(spark, staged, path) == ["day=2024-01-01", "day=2024-01-02"]
    assert content(spark, path) == [("a", 0, 2.0), ("b", 1, 2.0)]
    assert not files.path_exists(spark, f"{path}/_replaced")


def test_upsert_keeps_null_keys_of_both_sides(spark):
    old, new = trips(spark, [(None, 0, 1.0), ("a", 0, 1.0)]), trips(spark, [(None, 0, 2.0), ("a", 0, 2.0)])
    assert [r[2] for r in rows_of(upsert(old, new, ["id"]))] == [2.0, 1.0, 2.0]


def test_upsert_with_a_hot_partition_equals_a_dictionary(spark, folder):
    rng, path = random.Random(1), folder()
    expected, old, new = {}, [], []
    for i in range(400):
        day = 0 if i % 3 == 0 else rng.randrange(1, 20)
        old.append((f"k{i:03d}", day, 1.0))
        if i % 2:
            new.append((f"k{i:03d}", day, 2.0))
    for row in (*old, *new):
        expected[row[0]] = row
    writers.replace_partitions(trips(spark, old), path, ["day"])
    writers.upsert_into(spark, path, trips(spark, new), ["id"], "day")
    assert content(spark, path) == sorted(expected.values())


def landing(spark, folder, days):
    path = folder("landing")
    trips(spark, [(f"{d}-{i}", d, 1.0) for d in days for i in range(d + 1)]).withColumnRenamed(
        "day", "date"
    ).write.partitionBy("date").parquet(path)
    return path


def test_ingestion_skips_known_and_missing_days(spark, folder):
    source, bronze = landing(spark, folder, [0, 1, 3, 4]), folder("bronze")
    first = DateRange.of("2024-01-01", "2024-01-03")
    assert writers.append_new_days(spark, source, bronze, first) == (2, 1, 3)
    assert writers.append_new_days(spark, source, bronze, first) == (0, 3, 0)
    assert writers.append_new_days(spark, source, bronze, DateRange.of("2024-01-02", "2024-01-05")) == (2, 2, 9)
    counts = spark.read.parquet(bronze).groupBy("ingestion_date").count()
    assert [(r[0].day, r[1]) for r in rows_of(counts)] == [(1, 1), (2, 2), (4, 4), (5, 5)]


def test_ingestion_without_a_landing_folder_skips_all_days(spark, folder):
    assert writers.append_new_days(spark, folder("none"), folder("bronze"), DateRange.of("2024-01-01", "2024-01-03")) == (0, 3, 0)


def test_landing_in_parts_keeps_earlier_days(spark, folder):
    path = folder()
    data = [(d, dt.datetime(2024, 1, d)) for d in range(1, 7)]
    df = spark.createDataFrame(data, "n int, ts timestamp_ntz")
    writers.split_by_day(df.where("n <= 3"), path, "ts")
    writers.split_by_day(df.where("n > 3"), path, "ts")
    writers.split_by_day(df.where("n = 2"), path, "ts")
    assert [r.n for r in spark.read.parquet(path).orderBy("n").collect()] == [1, 2, 3, 4, 5, 6]


def test_missing_days(spark, folder):
    days = DateRange.of("2024-01-01", "2024-01-06")
    present = spark.read.parquet(landing(spark, folder, [0, 2, 9]))
    assert [r[0].day for r in rows_of(readers.missing_days(spark, days, present, "date"))] == [2, 4, 5, 6]
    assert readers.missing_days(spark, days, None, "date").count() == 6


def test_split_by_day_drops_rows_without_a_day(spark, folder):
    path = folder()
    data = [(1, dt.datetime(2023, 12, 31, 23, 59)), (2, dt.datetime(2024, 1, 1)), (3, None), (4, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(data, "n int, ts timestamp_ntz")
    writers.split_by_day(df, path, "ts", "date", DAY)
    assert [r.n for r in spark.read.parquet(path).orderBy("n").collect()] == [2, 4]
    writers.split_by_day(df, path, "ts")
    assert spark.read.parquet(path).count() == 3


def test_range_reads(spark, folder):
    path = landing(spark, folder, [0, 1, 2])
    assert readers.read_range(spark, path, "date", DateRange.of("2024-01-02", "2024-01-03")).count() == 5
    assert readers.read_day(spark, path, "date", "2024-01-01").count() == 1
    assert readers.read_range_or_none(spark, path, "date", DateRange.of("2025-01-01")) is None
    assert readers.read_range_or_none(spark, folder("none"), "date", DateRange.of("2025-01-01")) is None
    assert readers.latest_partition(spark.read.parquet(path), "date").first()[0] == dt.date(2024, 1, 3)


def test_only_a_missing_path_is_forgiven(spark, folder):
    path = folder()
    assert readers.read_parquet(spark, path, missing_ok=True) is None
    assert readers.present_days(spark, path, "date") is None
    with pytest.raises(AnalysisException):
        readers.read_parquet(spark, path)
    spark.range(1).selectExpr("'no parquet' AS value").write.text(path)
    with pytest.raises(Exception):  # noqa: B017 - the file is there but unreadable
        readers.read_parquet(spark, path, missing_ok=True).count()


def test_backfill_fills_only_holes(spark, folder):
    path = folder()
    df = trips(spark, [("kept", 0, 1.0), (None, 1, 2.0), ("also", 1, 3.0)])
    writers.replace_partitions(df, path, ["day"])
    untouched = {r.path for r in files.file_inventory(spark, path).collect() if "day=2024-01-01" in r.path}

    def key(table):
        return record_key(table, ["amount"])

    assert writers.backfill_column(spark, path, "id", key, "day") == 1
    assert writers.backfill_column(spark, path, "id", key, "day") == 0
    ids = {r[2]: r[0] for r in content(spark, path)}
    assert (ids[1.0], ids[3.0], len(ids[2.0])) == ("kept", "also", 32)
    assert untouched <= {r.path for r in files.file_inventory(spark, path).collect()}
    assert writers.backfill_column(spark, path, "other_id", key, "day") == 3
    assert spark.read.option("mergeSchema", "true").parquet(path).where("other_id IS NULL").count() == 0


def test_catalog_tables(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS strata_test LOCATION '{folder('db')}'")
    try:
        df = trips(spark, [("a", 0, 1.0)])
        assert catalog.create_if_absent(df, "strata_test.t", ["day"])
        assert not catalog.create_if_absent(df, "strata_test.t", ["day"])
        assert catalog.add_column_if_missing(spark, "strata_test.t", "note")
        assert not catalog.add_column_if_missing(spark, "strata_test.t", "note")
        assert readers.read_table(spark, "strata_test.t").select("note").first()[0] is None
        assert readers.read_table(spark, "strata_test.none", missing_ok=True) is None
        with pytest.raises(AnalysisException):
            readers.read_table(spark, "strata_test.none")
        df.createOrReplaceTempView("ad_hoc")
        assert spark.sql("SELECT sum(t.amount) FROM ad_hoc JOIN strata_test.t USING (id, day)").count() == 1
        assert [r.tableName for r in catalog.list_tables(spark, "strata_test").where("NOT isTemporary").collect()] == ["t"]
        left = catalog.drop_tables(spark, ["strata_test.t", "strata_test.none"], "strata_test")
        assert left.where("NOT isTemporary").count() == 0
    finally:
        spark.catalog.dropTempView("ad_hoc")
        spark.sql("DROP DATABASE IF EXISTS strata_test CASCADE")

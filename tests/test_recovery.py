"""Every directory move fails in turn; a repeated job must find and write all rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.sources import files, maintenance, publish, writers
from tests.conftest import rows_of

DAY = dt.date(2024, 1, 1)


def rows(spark, ids, amount, days=3):
    data = [(f"{i}{d}", DAY + dt.timedelta(days=d), amount) for d in range(days) for i in ids]
    return spark.createDataFrame(data, "id string, day date, amount double")


def upserted(spark, path):
    writers.upsert_into(spark, path, rows(spark, "bx", 9.0), ["id"], "day")


def moved(spark, path):
    """Keys of the last day move to the first."""
    source = rows(spark, "a", 9.0).where(F.col("day") == F.lit(DAY + dt.timedelta(days=2))).withColumn("day", F.lit(DAY))
    writers.upsert_into(spark, path, source.unionByName(rows(spark, "b", 9.0)), ["id"], "day", key_fixes_partition=False)


def published(spark, path):
    publish.publish(rows(spark, "abcx", 9.0), path, ["day"], {"some": F.count(F.lit(1)) > 0}, "run", f"{path}_log", f"{path}_manifest")


def backfilled(spark, path):
    writers.backfill_column(spark, path, "amount", lambda df: F.lit(7.0), "day")


def compacted(spark, path):
    maintenance.compact(spark, path, ["day"], target_bytes=1 << 30)


JOBS = [upserted, moved, published, backfilled, compacted]


def fresh(spark, path):
    old = rows(spark, "abc", 1.0).withColumn("amount", F.when(F.col("id").startswith("c"), F.lit(None)).otherwise(F.col("amount")))
    old.repartition(4).write.partitionBy("day").parquet(path)


@pytest.mark.parametrize("job", JOBS)
@pytest.mark.parametrize("died", [False, True], ids=["raised", "died"])
def test_no_failed_move_loses_a_row(spark, folder, monkeypatch, job, died):
    """``died``: no move works after the failure, as when the driver is gone; else only that one fails."""
    rename, path = files._rename, folder("whole")
    fresh(spark, path)
    job(spark, path)
    whole = rows_of(spark.read.parquet(path))
    assert len(whole) >= 9
    fails, tried = 0, True
    while tried:
        count, tried = [0], False
        path = folder(f"{job.__name__}-{fails}")
        fresh(spark, path)
        before = spark.read.parquet(path).count()

        def failing(system, source, target):
            count[0] += 1
            if count[0] == fails + 1 or (died and count[0] > fails):
                raise OSError("this move fails")
            rename(system, source, target)

        monkeypatch.setattr(files, "_rename", failing)
        try:
            job(spark, path)
        except OSError as error:
            assert "this move fails" in str(error)
            tried = True
        monkeypatch.setattr(files, "_rename", rename)
        if tried and not died and job is not moved:
            assert spark.read.parquet(path).count() >= before  # readers miss nothing meanwhile
        job(spark, path)
        assert rows_of(spark.read.parquet(path)) == whole
        assert not files.path_exists(spark, f"{path}/{files.REPLACED}")
        fails += 1
    assert fails > 3


def test_a_table_of_one_partition_comes_back(spark, folder):
    path = folder("single")
    rows(spark, "ab", 1.0, days=1).write.partitionBy("day").parquet(path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    system = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(make(f"{path}/{files.REPLACED}"))
    assert system.rename(make(f"{path}/day=2024-01-01"), make(f"{path}/{files.REPLACED}/day=2024-01-01"))
    upserted(spark, path)
    assert {r.id for r in spark.read.parquet(path).collect()} == {"a0", "b0", "x0", "b1", "x1", "b2", "x2"}


def test_a_staged_copy_stays_until_it_is_in_place(spark, folder, monkeypatch):
    path = folder("staged")
    fresh(spark, path)

    def failing(system, source, target):
        raise OSError("this move fails")

    monkeypatch.setattr(files, "_rename", failing)
    with pytest.raises(OSError):
        published(spark, path)
    assert spark.read.parquet(f"{path}_staging/run").count() == 12

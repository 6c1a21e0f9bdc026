from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import quantiles, sketches
from strata.plans.queries import QUERIES
from tests.conftest import SMALL

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Keys that return on other days, one key on a third of all rows, NULL keys and values."""
    frame = spark.range(60_000).select(
        F.date_add(F.lit(DAY), (F.col("id") % 14).cast("int")).alias("day"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 != 1, F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(9000)))).alias("key"),
        F.when(F.col("id") % 50 != 0, F.pow(F.rand(7), F.lit(3)) * 100).alias("value"),
    )
    return frame.persist()


def test_distinct_counts_of_any_days_stay_within_the_stated_error(rows):
    daily = sketches.daily_sketches(rows, "day", "key", "value").persist()
    for first, last in ((1, 1), (1, 7), (3, 12), (1, 14)):
        days = F.dayofmonth("day").between(first, last)
        exact, n = rows.where(days).agg(F.count_distinct("key"), F.count(F.lit(1))).first()
        found = sketches.merged_distinct(daily.where(days)).first()
        assert abs(found.distinct_keys - exact) <= sketches.DISTINCT_ERROR * exact
        assert found.rows == n
        assert abs(found.uniqueness_pct - 100 * exact / n) <= 100 * sketches.DISTINCT_ERROR * exact / n
    weeks = [F.dayofmonth("day") <= 7, F.dayofmonth("day") > 7]
    shared = sketches.shared_keys(daily, *weeks).first()
    keys = [{r.key for r in rows.where(w).select("key").distinct().collect()} - {None} for w in weeks]
    for estimate, exact in zip(shared, (keys[0], keys[1], keys[0] & keys[1])):
        assert abs(estimate - len(exact)) <= 2 * sketches.SET_ERROR * max(map(len, keys))


def test_quantiles_of_merged_days_have_their_rank(rows):
    daily = sketches.daily_sketches(rows, "day", "key", "value")
    wanted = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    estimates = sketches.merged_quantiles(daily, wanted, F.lit(1).alias("all"))
    errors = sketches.rank_errors(rows.withColumn("all", F.lit(1)), estimates, "value", wanted, ["all"]).first()
    assert all(errors[name] <= sketches.RANK_ERROR for name in wanted)
    exact = quantiles.exact_quantiles(rows.withColumn("all", F.lit(1)), ["all"], "value", wanted).first()
    found = estimates.first()
    assert all(abs(found[n] - exact[n]) < 0.1 * exact["p99"] for n in wanted)


def test_rank_errors_see_a_wrong_estimate(spark):
    values = spark.range(100).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("g"))
    wrong = spark.createDataFrame([(1, 70.0)], "g int, p50 double")
    assert sketches.rank_errors(values, wrong, "v", {"p50": 0.5}, ["g"]).first().p50 == pytest.approx(0.2)


@pytest.mark.parametrize("name", ["q_distinct_sketches", "q_shared_routes", "q_weekly_percentiles"])
def test_queries_stay_within_their_error(spark, name):
    assert all(r.within_error for r in QUERIES[name](spark, SMALL).collect())

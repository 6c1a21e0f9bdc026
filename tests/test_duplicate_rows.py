from __future__ import annotations

from strata.operators.dedup import duplicate_rows
from tests.conftest import final_plan


def test_rows_are_counted_with_nulls_and_equal_numbers(spark):
    rows = [(1, 0.0, None), (1, -0.0, None), (None, float("nan"), "x"), (None, float("nan"), "x"), (2, 1.0, "y"), (3, 1.0, "y")]
    df = spark.createDataFrame(rows, "a long, b double, c string").repartition(3)
    assert duplicate_rows(df).first()[:] == (6, 4, 2)
    assert duplicate_rows(df.where("a = 2")).first()[:] == (1, 1, 0)
    assert duplicate_rows(df.where("a > 9")).first()[:] == (0, 0, 0)


def test_rows_without_copies_are_not_shuffled(spark):
    ids = spark.range(1000).union(spark.range(10))
    plan = final_plan(duplicate_rows(ids.selectExpr("id", "id % 7 AS b", "string(id) AS c")))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert [node for node in ("SortMergeJoin", "NestedLoop") if node in plan] == []

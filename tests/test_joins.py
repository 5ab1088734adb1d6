"""Joins and sessions on repeated rows, null keys and null times: every layout gives the same rows."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from millrace.operators import joins, windows
from millrace.operators.project import distribute
from millrace.operators.sequence import sequence, tally

LEFT = [(1, "a", 10), (1, "a", 10), (2, "a", 30), (3, None, 10), (4, "a", None), (5, "b", 10)]
RIGHT = [(1, "a", 12), (2, "a", 12), (3, None, 10), (4, "b", None), (5, "c", 1)]


def sides(spark):
    time = F.timestamp_seconds("s").cast("timestamp_ntz")
    left = spark.createDataFrame(LEFT, "l long, k string, s long").select("l", "k", time.alias("lt"))
    right = spark.createDataFrame(RIGHT, "r long, k string, s long").select("r", "k", time.alias("rt"))
    return left, right


def test_reconciling_keeps_every_row(spark):
    args = ("k", "lt", "rt", "-5 seconds", "10 seconds")
    plain, bucketed = (rows_of(joins.reconcile_outer(*sides(spark), *args, bucketed=b), "l", "r", "kind") for b in (False, True))
    assert plain == bucketed
    assert [r[2] for r in bucketed].count("matched") == 4
    assert [r[2] for r in bucketed].count("left_only") == 4
    assert [r[2] for r in bucketed].count("right_only") == 3


def test_reach_is_told_in_one_shuffle(spark):
    args = (*sides(spark), "k", "lt", "rt", "-5 seconds", "10 seconds")
    told = joins.in_reach(*args, "both")
    assert rows_of(told, "l", "k", "_met") == [(1, "a", True), (1, "a", True), (2, "a", False), (3, None, False), (4, "a", False), (5, "b", False)]
    assert rows_of(joins.in_reach(*args), "l") == [(1,), (1,)]
    assert rows_of(joins.in_reach(*args, "left_anti"), "l") == [(2,), (3,), (4,), (5,)]
    assert told._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_reach_against_all_pairs(spark):
    rng = random.Random(4)
    time = F.timestamp_seconds("s").cast("timestamp_ntz")
    left, right = ([(i, rng.choice(["a", "a", "b", None]), rng.choice([None, *range(120)])) for i in range(80)] for _ in "lr")
    frames = (spark.createDataFrame(rows, f"{n} long, k string, s long").select(n, "k", time.alias(f"{n}t"))
              for n, rows in (("l", left), ("r", right)))
    got = joins.in_reach(*frames, "k", "lt", "rt", "-3 seconds", "1 second", "both")
    want = [(i, any(k is not None and k == o and None not in (s, t) and -3 <= t - s <= 1 for _, o, t in right)) for i, k, s in left]
    assert rows_of(got, "l", "_met") == want


def test_interval_joins_carry_the_bucket_and_run_no_job(spark):
    left, right = sides(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joined = joins.interval_join(left, right, "k", "lt", "rt", "-5 seconds", "10 seconds")
    assert len(tracker.getJobIdsForGroup(None)) == before
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join [k#" in plan and "_bucket#" in plan.split("Join [k#")[1].split("]")[0]


def test_matching_is_one_to_one(spark):
    left = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2)], "k string, x long")
    right = spark.createDataFrame([("a", 3), ("a", 5), ("a", 9), ("c", 1)], "k string, y long")
    got = rows_of(joins.match_join(left, right, "k", "x", "y"), "k", "x", "y", "completed_by")
    assert got == [("a", 1, 3, "right"), ("a", 4, 5, "right")]


def test_sessions_drop_rows_without_time(spark, layout):
    time = F.timestamp_seconds("s").cast("timestamp_ntz")
    rows = spark.createDataFrame([("a", 0, 1), ("a", 1, 3), ("a", 2, None), ("a", 3, 30), ("b", 4, None)], "k string, n long, s long")
    got = windows.session_hot(rows.withColumn("t", time), ["k"], "t", "n", "5 seconds", c=F.count("*"))
    assert rows_of(got, "k", "c") == [("a", 1), ("a", 2)]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_order_values_may_all_be_null(spark, layout, keys):
    rows = spark.createDataFrame([("a", None)] * 5, "k string, o long")
    assert sorted(r.n for r in sequence(rows, keys, ["o"]).running(n=tally()).df.collect())[-1] == 5


def test_one_task_gets_the_finished_result_only(spark):
    counted = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    plan = distribute(counted, "global")._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "REPARTITION_BY_NUM" in plan

"""What the physical plans must look like."""

import io
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, topn
from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence
from millrace.plans import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the shared tables")


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def shuffles(df):
    text = plan_of(df)
    return text[: text.index("(1)")].count("Exchange")


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_eq"](spark, SF))
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_ranking_is_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["hot_items_state"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2


def test_running_columns_share_one_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "value")
    assert shuffles(topn.running_top(events, ["user_id"], ["event_id"], "value")) == 1
    assert shuffles(aggregates.keyed_profile(events, ["user_id"], ["event_id"], "value")) == 1


def test_whole_table_scan_keeps_rows_out_of_one_partition(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value")
    plan = plan_of(sequence(events, [], ["event_id"]).running(total=seq.total("value")).df)
    # The only single partition holds one summary row per slice: it lies behind an aggregate.
    rows_side = plan.split("Union")[0]
    assert "SinglePartition" not in rows_side and "hashpartitioning(_slice" in plan


def test_no_product_joins(spark):
    for name in ("interval_join", "reconcile_outer", "control_broadcast", "hot_urls", "allowed_lateness", "running_distinct"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_counts_are_partial_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(aggregates.group_agg(events, ["user_id"], n=F.count("*")))
    assert "partial_count" in plan

"""Every registered batch query against its SQL twin, on the smallest tables.

Run once with ordinary windows and once with every key above ten rows cut
into slices, so that both ways give the same rows.
"""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import difference, duck  # noqa: E402

from millrace.operators.sequence import SLICE_ROWS_CONF, SLICE_ROWS_DEFAULT  # noqa: E402
from millrace.plans import ORACLES, QUERIES  # noqa: E402

SF = Path("/root/testdata/sf0.001")
STREAMS = {n for n, f in QUERIES.items() if f.__module__.endswith("streams")}
ORDERED = [
    "changelog", "running_sum", "running_max", "running_max_by", "running_avg", "running_distinct", "keyed_profile",
    "over_rows_bounded", "over_unbounded_et", "prev_value_jump", "running_top3", "no_drop_alert", "blacklist_filter",
    "login_fail_pairs", "login_fail_burst", "pattern_consecutive_3", "pattern_followed_by", "session_et", "count_slide",
    "count_tumble", "eager_trigger", "allowed_lateness", "reconcile_outer", "interval_join",
]

pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the shared tables")


@pytest.fixture(scope="module")
def con():
    return duck(str(SF))


def check(spark, con, name):
    got = QUERIES[name](spark, str(SF)).toPandas()
    assert difference(got, con.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_batch_query(spark, con, name):
    check(spark, con, name)


@pytest.mark.parametrize("name", ORDERED)
def test_ordered_query_in_slices(spark, con, name):
    spark.conf.set(SLICE_ROWS_CONF, "10")
    try:
        check(spark, con, name)
    finally:
        spark.conf.set(SLICE_ROWS_CONF, str(SLICE_ROWS_DEFAULT))


@pytest.mark.parametrize("name", ["stream_tumble_et", "stream_hot_items", "stream_changelog", "stream_no_drop_alert"])
def test_stream_query(spark, con, name):
    check(spark, con, name)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)

"""The sliced forms against plain Python on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import sequence as seq
from millrace.operators.alerts import login_fail_burst
from millrace.operators.joins import interval_join, reconcile_outer
from millrace.operators.sequence import sequence
from millrace.operators.windows import session_hot

QUIET = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.integers(0, 30), st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1, max_size=40,
)


def frame(spark, rows):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(numbered, "n long, k string, t long, v long")


@QUIET
@given(rows=ROWS, limit=st.integers(1, 5))
def test_running_matches_python(spark, rows, limit):
    made = sequence(frame(spark, rows), ["k"], ["t", "n"], limit=limit).running(
        total=seq.total("v"), nth=seq.tally(), high=seq.highest("v"), low=seq.lowest("v"),
        old=seq.earliest("v"), new=seq.latest("v"), prev=seq.previous("v"), before=seq.total("v").before(),
    )
    made = made.bounded(2, near=lambda w: F.sum("v").over(w.rowsBetween(-2, 0)), back=lambda w: F.lag("v", 2).over(w))
    made = made.reversed().running(nxt=seq.previous("v"), rest=seq.tally())
    got = {r.n: r for r in made.df.collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine = sorted((t, i, v) for i, (k, t, v) in enumerate(rows) if k == key)
        for place, (_, i, v) in enumerate(mine):
            upto = [x for _, _, x in mine[: place + 1] if x is not None]
            ahead = [x for _, _, x in mine[:place] if x is not None]
            near = [x for _, _, x in mine[max(0, place - 2) : place + 1] if x is not None]
            row = got[i]
            assert row.nth == place + 1 and row.rest == len(mine) - place
            assert row.total == (sum(upto) if upto else None) and row.before == (sum(ahead) if ahead else None)
            assert row.high == max(upto, default=None) and row.low == min(upto, default=None)
            assert row.old == (upto[0] if upto else None) and row.new == (upto[-1] if upto else None)
            assert row.prev == (mine[place - 1][2] if place else None)
            assert row.nxt == (mine[place + 1][2] if place + 1 < len(mine) else None)
            assert row.near == (sum(near) if near else None)
            assert row.back == (mine[place - 2][2] if place > 1 else None)


@QUIET
@given(rows=ROWS)
def test_whole_table_scan(spark, rows):
    made = sequence(frame(spark, rows), [], ["n"], limit=3).running(nth=seq.tally(), total=seq.total(F.coalesce("v", F.lit(0))))
    total = 0
    for r in sorted(made.df.collect(), key=lambda r: r.n):
        total += rows[r.n][2] or 0
        assert (r.nth, r.total) == (r.n + 1, total)


def test_hot_key_is_cut_and_cold_keys_are_not(spark):
    df = spark.range(3000).selectExpr("id as n", "if(id % 3 = 0, -1, id) as k", "1L as v")
    made = sequence(df, ["k"], ["n"], limit=100)
    assert made.sliced
    whole, cut = (p.rows for p in made.parts)
    assert whole.count() == 2000 and whole.where("k = -1").count() == 0
    slices = cut.groupBy("_slice").count().agg(F.count("*").alias("p"), F.max("count").alias("m")).first()
    assert cut.count() == 1000 and slices.p >= 10 and slices.m <= 100
    assert made.running(c=seq.tally()).df.where("k = -1").agg(F.max("c")).first()[0] == 1000


def test_rows_bunched_on_the_axis_are_still_cut(spark):
    # Nearly all rows of the key lie in one thousandth of its time range.
    df = spark.range(2000).selectExpr("id as n", "'a' as k", "if(id = 0, 0L, 1000000000L + id) as t")
    made = sequence(df, ["k"], ["t", "n"], limit=200)
    assert made.parts[1].rows.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 200


@QUIET
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=30), limit=st.integers(1, 4))
def test_sessions_match_python(spark, rows, limit):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "n long, k string, s long")
    df = df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    spark.conf.set(seq.SLICE_ROWS_CONF, str(limit))
    try:
        made = session_hot(df, ["k"], "t", "n", "5 seconds", c=F.count("*"))
        got = sorted((r.k, r.window_start.second + 60 * r.window_start.minute, r.c) for r in made.collect())
    finally:
        spark.conf.set(seq.SLICE_ROWS_CONF, str(seq.SLICE_ROWS_DEFAULT))
    want = []
    for key in "ab":
        last = None
        for s in sorted(s for k, s in rows if k == key):
            if last is None or s - last > 5:
                want.append([key, s, 0])
            want[-1][2] += 1
            last = s
    assert got == sorted(map(tuple, want))


@QUIET
@given(
    left=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), max_size=15, min_size=1),
    right=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), max_size=15, min_size=1),
)
def test_interval_joins_match_python(spark, left, right):
    time = F.timestamp_seconds("s").cast("timestamp_ntz")
    ldf = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "l long, k string, s long").select("l", "k", time.alias("lt"))
    rdf = spark.createDataFrame([(i, *r) for i, r in enumerate(right)], "r long, k string, s long").select("r", "k", time.alias("rt"))
    pairs = sorted(
        (i, j) for i, (k, a) in enumerate(left) for j, (m, b) in enumerate(right) if k == m and a - 3 <= b <= a + 4
    )
    lone_l = sorted(set(range(len(left))) - {i for i, _ in pairs})
    lone_r = sorted(set(range(len(right))) - {j for _, j in pairs})
    for bucketed in (False, True):
        inner = interval_join(ldf, rdf, "k", "lt", "rt", "-3 seconds", "4 seconds", bucketed)
        assert sorted((r.l, r.r) for r in inner.collect()) == pairs
        outer = reconcile_outer(ldf, rdf, "k", "lt", "rt", "-3 seconds", "4 seconds", bucketed=bucketed).collect()
        assert sorted((r.l, r.r) for r in outer if r.kind == "matched") == pairs
        assert sorted(r.l for r in outer if r.kind == "left_only") == lone_l
        assert sorted(r.r for r in outer if r.kind == "right_only") == lone_r


def bursts(rows, width):
    found = []
    for key in {k for k, _, _ in rows}:
        start, kept = None, []

        def close():
            if len(kept) >= 2:
                found.append((key, kept[0], kept[-1], len(kept)))

        for _, s, fails in sorted(((i, s, f) for i, (k, s, f) in enumerate(rows) if k == key), key=lambda r: (r[1], r[0])):
            if start is not None and s > start + width:
                close()
                start, kept = None, []
            if not fails:
                start, kept = None, []
            else:
                start = s if start is None else start
                kept = [*kept, s]
        close()
    return sorted(found)


@QUIET
@given(
    rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 25), st.sampled_from([True, True, True, False])), min_size=1, max_size=40),
    limit=st.sampled_from([3, 10_000]),
)
def test_bursts_match_python(spark, rows, limit):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, k string, s long, f boolean")
    df = df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    spark.conf.set(seq.SLICE_ROWS_CONF, str(limit))
    try:
        made = login_fail_burst(df, ["k"], "t", "n", F.col("f"), "2 seconds").collect()
    finally:
        spark.conf.set(seq.SLICE_ROWS_CONF, str(seq.SLICE_ROWS_DEFAULT))
    assert sorted((r.k, r.first_time.second, r.last_time.second, r.n) for r in made) == bursts(rows, 2)

"""Small inputs with results derived by hand under the exact event-time rules."""

from datetime import datetime, timedelta

from conftest import rows_of
from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.operators import aggregates, alerts, joins, over, patterns, topn, watermark, windows
from millrace.operators import sequence as seq
from millrace.operators.project import flatmap_tokens, split_stream
from millrace.sources import readers, schemas

KEY, ARRIVAL = ["id"], ["seq"]
BASE = datetime(2019, 12, 31, 18, 0, 0) + timedelta(hours=8)


def at(seconds):
    return datetime(2020, 1, 1, 2, 0, 0) + timedelta(seconds=seconds)


def first(df):
    return df.where("id = 'ws_001'")


def test_running_word_count(spark, layout):
    lines = spark.createDataFrame([(0, "hello spark"), (1, "hello delta"), (2, "hello arrow")], "n long, value string")
    words = lines.selectExpr("n", "posexplode(split(value, ' ')) as (p, word)").selectExpr("n * 10 + p as seq", "word", "1 as one")
    counted = aggregates.running_sum(words, ["word"], ["seq"], "one", "n")
    assert rows_of(counted, "word", "n", order="seq") == [
        ("hello", 1), ("spark", 1), ("hello", 2), ("delta", 1), ("hello", 3), ("arrow", 1)
    ]
    assert rows_of(flatmap_tokens(lines, "value").groupBy("word").agg(F.sum("n").alias("n")), "word", "n")[2] == ("hello", 3)


def test_delimited_with_corrupt_row(spark):
    lines = ["ws_001,1577844001,45", "ws_002,1577844015,43", '{"id":"ws_001","ts":1577844001,"vc":45}']
    df = readers.decode_delimited(spark.createDataFrame([(v,) for v in lines], "value string"), schemas.WATER_SENSOR)
    assert rows_of(readers.good_rows(df), "id", "ts", "vc") == [("ws_001", 1577844001, 45), ("ws_002", 1577844015, 43)]
    assert rows_of(readers.corrupt_rows(df), "_corrupt") == [(lines[2],)]
    decoded = readers.decode_json(spark.createDataFrame([(lines[2],)], "value string"), schemas.WATER_SENSOR)
    assert rows_of(decoded, "id", "vc") == [("ws_001", 45)]


def test_filters_and_routing(sensors):
    assert sensors.where("vc > 30").count() == 6
    main, side = split_stream(sensors, F.col("vc") >= 30, ["id", "vc"])
    assert main.count() == 6 and side.columns == ["id", "vc"] and side.count() == 3


def test_grouped(sensors):
    grouped = aggregates.group_agg(sensors, KEY, n=F.count("*"), total=F.sum("vc"))
    assert rows_of(grouped, "id", "n", "total") == [
        ("ws_001", 4, 92), ("ws_002", 1, 43), ("ws_003", 1, 42), ("ws_004", 1, 45), ("ws_005", 1, 43), ("ws_006", 1, 42)
    ]
    assert rows_of(first(udfs.udaf_avg(sensors, KEY, "vc")), "average") == [(23.0,)]
    top = udfs.udtaf_top2(sensors, KEY, "vc", "seq")
    assert rows_of(first(top), "vc", "rank") == [(18, "TOP2"), (45, "TOP1")]
    assert rows_of(top.where("id = 'ws_002'"), "vc", "rank") == [(43, "TOP1")]


def test_running_folds(sensors, layout):
    best = aggregates.running_max_by(sensors, KEY, ARRIVAL, "vc", "seq")
    assert rows_of(first(best), "best.vc", "best.ts", order="seq") == [(45, 1577844001)] * 4
    highest = aggregates.running_max(sensors, KEY, ARRIVAL, "vc", {"first_ts": "ts"})
    assert rows_of(first(highest), "max_vc", "first_ts", order="seq") == [(45, 1577844001)] * 4
    reduced = aggregates.running_reduce(sensors, KEY, ARRIVAL, "vc", "m")
    assert rows_of(first(reduced), "m", "ts", order="seq") == [(45, 1577844000 + s) for s in (1, 6, 7, 7)]
    average = aggregates.running_avg(sensors, KEY, ARRIVAL, "vc", "a")
    assert rows_of(first(average), "a", order="seq") == [(45.0,), (28.5,), (25.0,), (23.0,)]


def test_max_by_takes_the_latest_of_equal_values(spark, layout):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 4)], "seq long, id string, vc int")
    best = aggregates.running_max_by(df, KEY, ARRIVAL, "vc", "seq")
    assert rows_of(best, "best.seq", order="seq") == [(1,), (2,), (2,)]


def test_jump_top_and_frames(sensors, layout):
    jumps = over.prev_value_jump(sensors, KEY, ARRIVAL, "vc", 10)
    assert rows_of(jumps, "id", "previous_value", "vc") == [("ws_001", 45, 12)]
    top = topn.running_top(sensors, KEY, ARRIVAL, "vc")
    assert rows_of(first(top), "top1", "top2", "top3", order="seq") == [
        (45, None, None), (45, 12, None), (45, 18, 12), (45, 18, 17)
    ]
    framed = over.over_rows(sensors, KEY, ARRIVAL, 2, total=F.sum("vc"))
    assert rows_of(first(framed), "total", order="seq") == [(45,), (57,), (75,), (47,)]
    peers = over.over_unbounded_peers(sensors, KEY, "rt", n=seq.tally())
    assert rows_of(first(peers), "n", order="seq") == [(1,), (2,), (4,), (4,)]


def test_windows(sensors, layout):
    tumbled = windows.tumble(sensors, KEY, "rt", "5 seconds", total=F.sum("vc"))
    assert rows_of(first(tumbled), "window_start", "total") == [(at(0), 45), (at(5), 47)]
    sessions = windows.session_hot(sensors, KEY, "rt", "seq", "5 seconds", total=F.sum("vc"))
    assert rows_of(first(sessions), "window_start", "window_end", "total") == [(at(1), at(12), 92)]
    assert windows.count_tumble(sensors, KEY, ARRIVAL, 5, total=F.sum("vc")).count() == 0
    slid = windows.count_slide(sensors, KEY, ARRIVAL, 5, 2, total=lambda w: F.sum("vc").over(w))
    assert rows_of(first(slid), "total", order="seq") == [(57,), (92,)]


def test_panes_equal_expansion(sensors):
    plain = windows.slide(sensors, KEY, "rt", "6 seconds", "2 seconds", total=F.sum("vc"))
    panes = windows.slide_panes(sensors, KEY, "rt", "6 seconds", "2 seconds", total=("sum", "vc"))
    columns = ("id", "window_start", "window_end", "total")
    assert rows_of(panes, *columns) == rows_of(plain, *columns)


def test_changelog(sensors, layout):
    changes = aggregates.changelog(sensors, KEY, ARRIVAL, {"total": seq.total("vc")})
    got = sorted((r.seq, r.is_insert, r.total) for r in first(changes).collect())
    assert got == [(0, True, 45), (6, False, 45), (6, True, 57), (7, False, 57), (7, True, 75), (8, False, 75), (8, True, 92)]


def logins(spark):
    rows = [(0, "fail", 844), (1, "fail", 842), (2, "fail", 843)]
    df = spark.createDataFrame(rows, "seq long, kind string, s long")
    return df.selectExpr("seq", "1035L as user", "kind", "cast(timestamp_seconds(s) as timestamp_ntz) as t", "s")


def seconds(column):
    return F.unix_seconds(F.col(column).cast("timestamp"))


def test_login_failures(spark, layout):
    fails = F.col("kind") == "fail"
    pairs = alerts.login_fail_pairs(logins(spark), ["user"], "t", ARRIVAL, fails, "2 seconds")
    assert rows_of(pairs, seconds("previous_time"), "s") == [(842, 843), (844, 842)]
    found = patterns.pattern_consecutive(logins(spark), ["user"], "t", "seq", fails, 2, "5 seconds")
    assert rows_of(found, seconds("first_time"), "s") == [(842, 843), (843, 844)]


def orders(spark):
    rows = [
        (0, 34729, "create", 842), (1, 34729, "pay", 844), (2, 34756, "create", 913), (3, 34768, "pay", 950),
        (4, 34756, "pay", 1951), (5, 34700, "create", 1000), (6, 34700, "pay", 1900),
    ]
    df = spark.createDataFrame(rows, "seq long, id long, kind string, s long")
    return df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))


def test_order_payment(spark, layout):
    is_create, is_pay = F.col("kind") == "create", F.col("kind") == "pay"
    states = alerts.order_pay_monitor(orders(spark), "id", "t", "seq", is_create, is_pay, "15 minutes")
    # A pay exactly 15 minutes after the create is in time for the timer rule.
    assert rows_of(states, "id", "kind") == [
        (34700, "paid"), (34729, "paid"), (34756, "no_pay"), (34756, "pay_without_create"), (34768, "pay_without_create")
    ]
    found = patterns.pattern_followed_by(orders(spark), ["id"], "t", "seq", is_create, is_pay, "15 minutes")
    # and too late for the pattern rule.
    assert rows_of(found, "id", "kind", seconds("timeout_time")) == [
        (34700, "timeout", 1900), (34729, "matched", None), (34756, "timeout", 1813)
    ]


def payments(spark):
    pays = [("a", 844), ("b", 849), ("c", 863), ("d", 893), ("e", 900)]
    receipts = [("a", 847), ("c", 859), ("d", 893), ("e", 911), ("f", 845)]
    time = F.timestamp_seconds("s").cast("timestamp_ntz")
    left = spark.createDataFrame(pays, "tx string, s long").select("tx", time.alias("pt"))
    right = spark.createDataFrame(receipts, "tx string, s long").select("tx", time.alias("rt"))
    return left, right


def test_reconciliation_by_interval(spark):
    left, right = payments(spark)
    for bucketed in (False, True):
        inner = joins.interval_join(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", bucketed)
        assert rows_of(inner, "tx") == [("a",), ("c",), ("d",)]
        outer = joins.reconcile_outer(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", bucketed=bucketed)
        assert rows_of(outer, "tx", "kind") == [
            ("a", "matched"), ("b", "left_only"), ("c", "matched"), ("d", "matched"),
            ("e", "left_only"), ("e", "right_only"), ("f", "right_only"),
        ]
    matched = joins.match_join(left, right, "tx", "pt", "rt")
    assert rows_of(matched, "tx", "completed_by") == [("a", "right"), ("c", "left"), ("d", "right"), ("e", "right")]


def test_blacklist(spark, layout):
    time = F.expr("timestamp_ntz'2024-01-01 15:00:00' + make_interval(0,0,0,0,0,0,seq * 600)").alias("t")
    clicks = spark.range(12).withColumnRenamed("id", "seq").select("seq", F.lit(7).alias("user"), time)
    passed, warned = alerts.blacklist_filter(clicks, ["user"], "t", ARRIVAL, 4, "8 hours")
    # Local midnight is 16:00: six clicks fall on each local day.
    assert rows_of(passed, "seq") == [(0,), (1,), (2,), (6,), (7,), (8,)]
    assert rows_of(warned, "seq") == [(3,), (9,)]


def test_allowed_lateness_and_side_output(spark, layout):
    times = [1, 3, 6, 4, 8, 2, 12, 9]
    rows = [(i, "k", t, 1.0) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "seq long, k string, s long, v double")
    df = df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    fired = watermark.allowed_lateness(df, ["k"], "t", "seq", "5 seconds", "1 seconds", "2 seconds", "v")
    # Row 4 meets watermark 5: window [0,5) has just closed and fires again; row 2 meets 7 and is lost.
    assert rows_of(fired, seconds("window_start"), "firing", "n") == [(0, 0, 2), (0, 1, 3), (5, 0, 2), (5, 1, 3), (10, 0, 1)]
    main, late = watermark.late_side_output(df, "t", "seq", "5 seconds", "1 seconds", lateness="2 seconds")
    assert rows_of(late, "s") == [(2,)] and main.count() == 7


def test_no_drop_alert(spark, layout):
    rows = [(0, 0, 5), (1, 7, 6), (2, 21, 4), (3, 25, 4), (4, 35, 9), (5, 36, 1)]
    df = spark.createDataFrame(rows, "seq long, s long, v int").withColumn("id", F.lit("x"))
    df = df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    found = alerts.no_drop_alert(df, KEY, "t", "seq", "v", "10 seconds")
    # Stretch from 0 to the drop at 21; the next one starts at 25 and its alert at 35 precedes the drop at 36.
    assert rows_of(found, seconds("since"), seconds("alert_time")) == [(0, 10), (0, 20), (25, 35)]


def test_burst_edges(spark, layout):
    rows = [
        # user, second, kind: the span is 2 seconds, its end included
        ("a", 0, "fail"), ("a", 2, "fail"), ("a", 3, "fail"), ("a", 4, "fail"), ("a", 9, "fail"),
        ("b", 0, "fail"), ("b", 1, "fail"), ("b", 2, "ok"), ("b", 10, "fail"), ("b", 11, "fail"), ("b", 13, "ok"),
        ("c", 0, "fail"), ("c", 1, "ok"), ("c", 1, "fail"), ("c", 2, "fail"),
    ]
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "seq long, id string, s long, kind string")
    df = df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    found = alerts.login_fail_burst(df, KEY, "t", "seq", F.col("kind") == "fail", "2 seconds")
    assert rows_of(found, "id", seconds("first_time"), seconds("last_time"), "n") == [
        ("a", 0, 2, 2), ("a", 3, 4, 2), ("b", 10, 11, 2), ("c", 1, 2, 2)
    ]


def test_records_that_cannot_be_read_are_kept(spark):
    lines = spark.createDataFrame([("{\"id\":\"a\",\"ts\":1,\"vc\":2}",), ("{\"id\":",), ("[]x",), (None,)], "value string")
    got = readers.decode_json(lines, schemas.WATER_SENSOR, rejects=True)
    assert sorted(r[0] for r in readers.corrupt_rows(got).collect()) == ["[]x", "{\"id\":"]
    log = spark.createDataFrame([("1.1.1.1 u - 01/02/2024:10:00:00 +0000 GET /a",), ("1.1.1.1 u - tomorrow +0000 POST /a",), ("x",),
                                 ("1.1.1.1 u - 01/02/2024:10:00:00 +0000 POST /b",)], "value string")
    got = readers.decode_web_log(log, rejects=True)
    assert [r["url"] for r in readers.good_rows(got).collect()] == ["/a"]
    assert sorted(r[0] for r in readers.corrupt_rows(got).collect()) == ["1.1.1.1 u - tomorrow +0000 POST /a", "x"]


def test_user_aggregates_keep_large_keys_and_values(spark):
    big = 2**60 + 1
    rows = [(big, 1), (big, None), (big + 1, big), (None, 3), (None, 4)]
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    from millrace.functions.udfs import udaf_avg
    from millrace.operators.aggregates import user_aggregate

    got = user_aggregate(df, ["k"], "v", {"top": "max"}, lambda g: {"top": g.max()}, F.col("top"), "top", {"top": "bigint"})
    assert {tuple(r) for r in got.collect()} == {(big, 1), (big + 1, big), (None, 4)}
    assert {r["k"]: r["average"] for r in udaf_avg(df, ["k"], "v").collect()} == {big: 1.0, big + 1: float(big), None: 3.5}

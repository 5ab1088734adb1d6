"""Replays, end of input, and keyed state between micro-batches, against the batch forms and against one batch."""

import random
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_streams import make, stream_of

from millrace.operators import aggregates, alerts, joins, over, patterns, topn, windows
from millrace.operators import sequence as seq
from millrace.session import scratch
from millrace.streaming import carried
from millrace.streaming import replay as replay_module
from millrace.streaming.replay import measured_delay, open_replay, write_replay
from millrace.streaming.runtime import run_batches, run_to_files, unix_times

KEYS = ["k"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(21)
    rows = [(i, rng.choice(["a", "a", "b", None]), i * 2 + rng.randint(0, 9), rng.choice([None, *range(50)]), rng.choice(["fail", "ok", "fail", "pay"]))
            for i in range(90)]
    return [(n, k, s, None if v is None else float(v), kind) for n, k, s, v, kind in rows]


@pytest.fixture
def snapshots(monkeypatch):
    monkeypatch.setattr(carried, "SNAPSHOT", 2)


def arrivals(spark, data, files=4):
    return stream_of(spark, data, sentinel=False, files=files)


# ------------------------------------------------------------------ arrival order

def test_running_values(spark, data, layout, snapshots):
    batch = make(spark, data)
    columns = {"c": seq.tally(), "total": seq.total("v"), "m": seq.highest(F.struct("v", "n")), "p": seq.previous("v"),
               "f": seq.earliest("v"), "l": seq.latest("v"), "o": seq.total("v").before()}
    got = carried.running(arrivals(spark, data), KEYS, "n", "all", **columns)
    want = seq.sequence(batch, KEYS, ["n"]).running(**columns).df
    assert rows_of(got, "n", *columns) == rows_of(want, "n", *columns)


def test_recent_rows_and_changes(spark, data):
    batch = make(spark, data)
    total = lambda w: F.sum("v").over(w.rowsBetween(-3, 0))
    got = carried.sliding_rows(arrivals(spark, data), KEYS, "n", 4, "slide", total=total)
    want = seq.sequence(batch, KEYS, ["n"]).running(nth=seq.tally()).bounded(3, total=total).df
    assert rows_of(got, "n", "nth", "total") == rows_of(want, "n", "nth", "total")
    columns = {"c": seq.tally(), "total": seq.total("v")}
    got = carried.changelog(arrivals(spark, data), KEYS, "n", columns)
    want = aggregates.changelog(batch, KEYS, ["n"], columns)
    assert rows_of(got, "n", "is_insert", "c", "total") == rows_of(want, "n", "is_insert", "c", "total")


def test_running_top(spark, data):
    rows = [r for r in data if r[3] is not None]
    got = carried.running_top(arrivals(spark, rows), KEYS, "n", "v", 3)
    want = topn.running_top(make(spark, rows), KEYS, ["n"], "v", 3)
    names = [c for c in want.columns if c.startswith("top")]
    assert rows_of(got, "n", *names) == rows_of(want, "n", *names)


def test_pairs_first_come_first_served(spark, snapshots):
    rng = random.Random(3)
    rows = [(i, rng.choice("abc"), i, None, rng.choice("lr")) for i in range(60)] + [(60, None, 60, None, "l"), (61, None, 61, None, "r")]
    tagged = lambda df: df.select("k", "n", F.col("kind").alias("side"))
    got = carried.match_pairs(tagged(arrivals(spark, rows)), "k", "n")
    batch = tagged(make(spark, rows))
    left, right = (batch.where(F.col("side") == s).select("k", F.col("n").alias(c)) for s, c in (("l", "ln"), ("r", "rn")))
    want = joins.match_join(left, right, "k", "ln", "rn")
    assert rows_of(got, "k", "left_n", "right_n", "completed_by") == rows_of(want, "k", "ln", "rn", "completed_by")


def test_control_stream_switches_inside_and_between_batches(spark):
    rows = [(i, "x", i, float(i), "switch" if i in (3, 4, 17, 40) else "data") for i in range(60)]
    got = carried.label_by_control(
        arrivals(spark, rows, files=4).select("n", "v", "kind"), "n", F.col("kind") == "switch", F.col("v"), "newest")
    newest = lambda i: max((float(s) for s in (3, 4, 17, 40) if s < i), default=None)
    assert rows_of(got, "n", "newest") == [(i, newest(i)) for i in range(60) if i not in (3, 4, 17, 40)]


def test_old_keys_expire(spark, monkeypatch):
    monkeypatch.setattr(carried, "SNAPSHOT", 2)
    rows = [(i, f"k{i // 10}", i * 60, 1.0, "x") for i in range(60)]
    path = scratch(spark, "ttl")
    state = carried.RunningState(spark, path, ["k", "t"], ["n"], {"c": seq.tally()}, ttl=("t", "10 minutes"))
    run_batches(arrivals(spark, rows, files=6), lambda b, n: state.step(b, n).count(), scratch(spark, "ttl-run"))
    kept = spark.read.parquet(f"{path}/whole-5")
    assert kept.count() == 11 and kept.agg(F.min("t")).first()[0] == make(spark, rows[49:50]).first()["t"]


def test_a_repeated_batch_counts_once(spark, data):
    base, calls = scratch(spark, "again"), []
    state = carried.RunningState(spark, f"{base}/state", KEYS, ["n"], {"c": seq.tally()})
    out = carried.Output(spark, base)

    def each(batch, batch_id):
        out.store(state.step(batch, batch_id), batch_id)
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost after the write")

    stream = arrivals(spark, data)
    with pytest.raises(Exception, match="lost after the write"):
        run_batches(stream, each, base)
    run_batches(stream, each, base)
    assert calls == [0, 1, 1, 2, 3]
    want = seq.sequence(make(spark, data), KEYS, ["n"]).running(c=seq.tally()).df
    assert rows_of(out.read(), "n", "c") == rows_of(want, "n", "c")


# --------------------------------------------------------------- event-time order

@pytest.fixture(scope="module")
def mixed(spark, data):
    """The rows in five files that overlap in time by up to twelve seconds, with the delay they need, and flushed."""
    rng = random.Random(5)
    rows = [r for r in data if r[1] is not None]
    order = sorted(rows, key=lambda r: r[2] + rng.randint(-6, 6))
    path = scratch(spark, "mixed")
    for i in range(0, len(order), 18):
        make(spark, order[i : i + 18]).coalesce(1).write.mode("append").parquet(path)
    return open_replay(spark, path, "t"), make(spark, rows)


def flushed(replay, beyond, exact=False):
    """A copy of the folder's files in their order, and the last row."""
    spark = replay.spark
    path = scratch(spark, "copy")
    files = spark.read.parquet(replay.path).select("_metadata.file_path", "_metadata.file_modification_time").distinct().orderBy("file_modification_time")
    for row in files.collect():
        spark.read.schema(replay.schema).parquet(row["file_path"]).write.mode("append").parquet(path)
    copy = open_replay(spark, path, replay.time)
    assert copy.delay == replay.delay != "0 milliseconds"
    return copy.flush(beyond, exact=exact)


def test_patterns_in_event_order(spark, mixed):
    replay, batch = mixed
    fails = F.col("kind") == "fail"
    source = flushed(replay, "20 seconds")
    got = carried.consecutive(source.stream(), KEYS, "t", "n", source.delay, fails, 3, "30 seconds")
    want = patterns.pattern_consecutive(batch, KEYS, "t", "n", fails, 3, "30 seconds")
    assert rows_of(got, "first_n", "n") == rows_of(want, "first_n", "n")
    begin, answer = F.coalesce(F.col("v") < 15, F.lit(False)), F.coalesce(F.col("v") > 35, F.lit(False))
    got = carried.followed_by(source.stream(), KEYS, "t", "n", source.delay, begin, answer, "12 seconds")
    want = patterns.pattern_followed_by(batch, KEYS, "t", "n", begin, answer, "12 seconds")
    assert rows_of(got, "begin_n", "then_n", "kind", "timeout_time") == rows_of(want, "begin_n", "then_n", "kind", "timeout_time")
    got = carried.bursts(source.stream(), KEYS, "t", "n", source.delay, fails, "9 seconds")
    want = alerts.login_fail_burst(batch, KEYS, "t", "n", fails, "9 seconds")
    assert rows_of(got, "k", "first_time", "last_time", "n") == rows_of(want, "k", "first_time", "last_time", "n")
    create, pay = F.col("kind") == "ok", F.col("kind") == "pay"
    got = carried.order_pay(source.stream(), "k", "t", "n", source.delay, create, pay, "10 seconds")
    want = alerts.order_pay_monitor(batch, "k", "t", "n", create, pay, "10 seconds")
    assert rows_of(got, "k", "kind", "create_time", "pay_time") == rows_of(want, "k", "kind", "create_time", "pay_time")


def test_no_drop_and_peers_in_event_order(spark, mixed):
    replay, batch = mixed
    source = flushed(replay, "0 seconds", exact=True)
    got = carried.no_drop(source.stream(), KEYS, "t", "n", source.delay, "v", "5 seconds")
    want = alerts.no_drop_alert(batch, KEYS, "t", "n", "v", "5 seconds")
    assert rows_of(got.where("k is not null"), "k", "since", "nth") == rows_of(want, "k", seq.ticks(want, "since"), "nth")
    got = carried.over_unbounded(source.stream(), KEYS, "t", source.delay, c=seq.tally(), total=seq.total("v"))
    want = over.over_unbounded_peers(batch, KEYS, "t", c=seq.tally(), total=seq.total("v"))
    assert rows_of(got.where("n is not null"), "n", "c", "total") == rows_of(want, "n", "c", "total")


def test_open_begins_do_not_outlive_their_wait(spark):
    rows = [(i, "a", i * 10, 1.0, "begin") for i in range(40)]
    replay = write_replay(make(spark, rows), "t", steps=8)
    kept = []
    real = carried.WholeRows.leave

    def leave(self, rows, batch_id):
        real(self, rows, batch_id)
        kept.append(self.before(batch_id + 1).count())

    carried.WholeRows.leave = leave
    try:
        carried.followed_by(replay.stream(), KEYS, "t", "n", "0 seconds", F.lit(True), F.lit(False), "25 seconds")
    finally:
        carried.WholeRows.leave = real
    assert len(kept) == 8 and max(kept) <= 3


def test_late_rows_go_to_a_table_of_their_own(spark):
    rows = [(0, "a", 1, 1.0, "x"), (1, "a", 30, 1.0, "x"), (2, "a", 3, 1.0, "x"), (3, "a", 29, 1.0, "x")]
    order = carried.EventOrder(spark, scratch(spark, "late"), "t", "2 seconds")
    seen = []
    stream = stream_of(spark, rows, sentinel=False)
    run_batches(stream, lambda b, n: seen.append(rows_of(order.release(b, n)[0], "n")), scratch(spark, "late-run"))
    assert seen == [[], [(0,)], [], []]
    assert rows_of(order.late(stream.schema, 3), "n") == [(2,)]
    assert rows_of(spark.read.parquet(f"{order.base}/held/3").where("not _late"), "n") == [(1,), (3,)]


# ------------------------------------------------------------------- re-fired windows

def test_windows_fire_again_and_are_purged(spark):
    rows = [(0, "a", 1, 1.0, "x"), (1, "a", 12, 1.0, "x"), (2, "a", 3, 5.0, "x"), (3, "a", 14, 1.0, "x"), (4, "a", 40, 1.0, "x"), (5, "a", 4, 1.0, "x")]
    stream = stream_of(spark, rows, sentinel=False, files=6)
    fired, late = carried.allowed_lateness(stream, KEYS, "t", "10 seconds", "0 seconds", "5 seconds", value="v")
    start = lambda s: (100_000 + s) * 1_000_000
    assert rows_of(fired, "start", "firing", "n", "total") == [(start(0), 0, 1, 1.0), (start(0), 1, 2, 6.0), (start(10), 0, 2, 2.0)]
    assert rows_of(late, "n") == [(5,)]


def test_sliding_windows_fire_with_every_row_in_time(spark, mixed):
    replay, batch = mixed
    source = flushed(replay, "1 minute")
    fired, late = carried.allowed_lateness(source.stream(), KEYS, "t", "10 seconds", source.delay, "0 seconds", step="4 seconds")
    want = windows.slide(batch, KEYS, "t", "10 seconds", "4 seconds", n=F.count(F.lit(1)))
    got = fired.where("k is not null")
    assert late.count() == 0 and rows_of(got, "k", "start", "n") == rows_of(want, "k", seq.ticks(want, "window_start"), "n")


# ----------------------------------------------------------------- replays and joins

def test_a_replay_needs_no_delay_and_keeps_every_row(spark, data):
    batch = make(spark, data).withColumn("t", F.when(F.col("n") != 7, F.col("t")))
    replay = write_replay(batch, "t", steps=5)
    assert replay.delay == "0 milliseconds"
    assert rows_of(spark.read.parquet(replay.path), "n") == [(i,) for i in range(90)]
    batches = []
    run_batches(replay.stream(), lambda b, n: batches.append(b.agg(F.min("t"), F.max("t"), F.count("*")).first()), scratch(spark, "steps"))
    assert len(batches) >= 5
    timed = [b for b in batches if b[0] is not None]
    assert all(a[1] <= b[0] for a, b in zip(timed, timed[1:]))


def test_measured_delay_of_files_in_any_order(spark):
    path = scratch(spark, "files")
    for part in ([10, 20], [15, 40], [5, 50]):
        make(spark, [(s, "a", s, 1.0, "x") for s in part]).coalesce(1).write.mode("append").parquet(path)
    assert measured_delay(spark, path, spark.read.parquet(path).schema, "t") == "35001 milliseconds"


@pytest.mark.parametrize("files", ["ordered", "mixed"])
def test_joins_of_several_batches_lose_nothing(spark, files):
    rng = random.Random(8)
    pays = [(i, f"t{i}", rng.randint(0, 400), None, "p") for i in range(80)]
    receipts = [(i, f"t{rng.randint(0, 100)}", rng.randint(0, 420), None, "r") for i in range(90)]
    receipts += [(100 + i, p[1], p[2] + rng.randint(-8, 14), None, "r") for i, p in enumerate(pays) if i % 2]
    batch = [make(spark, r).select(F.col("k").alias("tx"), F.col("t").alias(c)) for r, c in ((pays, "pt"), (receipts, "rt"))]

    def source(df, time):
        if files == "ordered":
            return write_replay(df, time, steps=4)
        path = scratch(spark, "mixed")
        for part in range(4):
            df.where(F.pmod(F.xxhash64("tx", time), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(path)
        return open_replay(spark, path, time, df.schema)

    both = [source(df, t) for df, t in zip(batch, ("pt", "rt"))]
    last = max(r.last() for r in both)
    left, right = (r.flush("1 minute", last=last, tx=f"end{i}").timed() for i, r in enumerate(both))
    got = run_to_files(joins.interval_join(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", False), "inner")
    want = joins.interval_join(*batch, "tx", "pt", "rt", "-5 seconds", "10 seconds")
    assert rows_of(unix_times(got, "pt", "rt"), "tx", "pt", "rt") == rows_of(want, "tx", "pt", "rt")
    got = run_to_files(joins.reconcile_outer(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", bucketed=False), "outer")
    want = joins.reconcile_outer(*batch, "tx", "pt", "rt", "-5 seconds", "10 seconds")
    assert rows_of(unix_times(got, "pt", "rt"), "tx", "pt", "rt", "kind") == rows_of(want, "tx", "pt", "rt", "kind")


def test_sessions_and_windows_are_flushed(spark, data):
    rows = [r for r in data if r[1] is not None]
    batch = make(spark, rows)
    source = write_replay(batch, "t").flush("1 minute")
    got = unix_times(run_to_files(windows.session(source.timed(), KEYS, "t", "4 seconds", c=F.count("*")), "s"), "window_start")
    want = windows.session(batch, KEYS, "t", "4 seconds", c=F.count("*"))
    assert rows_of(got, "k", "window_start", "c") == rows_of(want, "k", "window_start", "c")


def test_nothing_at_all(spark):
    empty = make(spark, [(0, "a", 1, 1.0, "x")]).limit(0)
    replay = write_replay(empty, "t").flush("1 day")
    assert replay.last() is None
    got = carried.running(replay.stream(), KEYS, "n", "nothing", c=seq.tally()) if spark.read.parquet(replay.path).count() else None
    assert got is None


def test_an_upsert_table_is_compacted_while_it_runs(spark, monkeypatch):
    from millrace.sinks.writers import UpsertTable

    monkeypatch.setattr(UpsertTable, "SNAPSHOT", 3)
    rng = random.Random(4)
    table, newest = UpsertTable(spark, scratch(spark, "upsert") + "/table", ["k"], ["n"]), {}
    for batch_id in range(8):
        rows = [(batch_id * 10 + i, rng.choice("abcdefgh"), i, float(i), "x") for i in range(4)]
        newest.update({r[1]: r[0] for r in rows})
        table.merge(make(spark, rows), batch_id)
        if batch_id == 5:  # repeated after a failure, snapshot included
            table.merge(make(spark, rows), batch_id)
        assert rows_of(table.read(), "k", "n") == sorted(newest.items())
    assert table.snapshot() == 5
    plan = table._versions()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+ > 5\)", plan)  # older folders are not opened


def test_a_micro_batch_takes_a_whole_step(spark, monkeypatch):
    """However many files the tasks write, and also where a step has hardly any rows."""
    monkeypatch.setattr(replay_module, "_tasks", lambda spark, steps: 3)
    with_splits = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "1m"}
    rows = make(spark, [(i, f"k{i % 7}", i * 3 % 400, 0.0, "x") for i in range(400)])
    old = {name: spark.conf.get(name) for name in with_splits}
    try:
        for name, value in with_splits.items():
            spark.conf.set(name, value)
        by_time = write_replay(rows, "t")
        arrivals = write_replay(rows, "t", step=F.expr("case when n < 2 then 0 when n < 100 then 2 else 3 end"))
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)

    def seen(replay):
        found = []
        run_batches(replay.stream(), lambda b, n: found.append(sorted(r["n"] for r in b.select("n").collect())), scratch(spark, "steps"))
        return found

    assert by_time.files_per_step > 1 and by_time.delay == "0 milliseconds"
    assert [len(b) for b in seen(by_time)] == [100, 100, 100, 100]
    assert seen(arrivals) == [[0, 1], [], list(range(2, 100)), list(range(100, 400))]
    assert seen(arrivals.flush("1 minute"))[:4] == seen(arrivals)[:4] and len(seen(arrivals)) == 5
    counts = arrivals.timed().groupBy(F.window("t", "30 seconds")).agg(F.count("*").alias("c"))
    assert run_to_files(counts, "late").agg(F.sum("c")).first()[0] == 400


@pytest.mark.parametrize("files", ["ordered", "mixed"])
def test_joins_over_carried_rows(spark, files):
    """Equal rows, rows without key or time, and matches over several batches; only rows that may still meet are carried."""
    rng = random.Random(9)
    pays = [(i, rng.choice([None, "a", *"bcdefghij"]), rng.randint(0, 300), None, "p") for i in range(60)]
    receipts = [(i, rng.choice([None, "a", *"bcdefghij"]), rng.randint(0, 320), None, "r") for i in range(70)]
    pays, receipts = pays + pays[:5], receipts + receipts[:5]
    left, right = (
        make(spark, rows).select(F.col("k").alias("tx"), "n", F.when(F.col("n") != 3, F.col("t")).alias(time)).withColumnRenamed("n", f"n_{time}")
        for rows, time in ((pays, "pt"), (receipts, "rt")))

    def source(df, time):
        if files == "ordered":
            return write_replay(df, time, steps=4)
        path = scratch(spark, "mixed")
        for part in range(4):
            df.where(F.pmod(F.xxhash64(f"n_{time}"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(path)
        return open_replay(spark, path, time, df.schema)

    both = source(left, "pt"), source(right, "rt")
    last = max(r.last() for r in both)
    l, r = (x.flush("1 minute", last=last, tx=f"end{i}") for i, x in enumerate(both))
    on = ("tx", "pt", "rt", "-5 seconds", "10 seconds")
    for label, join, how in (
        ("inner", lambda a, b: joins.interval_join(a, b, *on), {}),
        ("outer", lambda a, b: joins.reconcile_outer(a, b, *on), {"outer": "lr"}),
    ):
        got = carried.joined(l.stream(), r.stream(), "tx", ("pt", "rt"), (l.delay, r.delay), on[3:], join, label, **how)
        names = [c for c in join(left, right).columns if c != "tx"]
        assert rows_of(got, "tx", *names) == rows_of(join(left, right), "tx", *names)
    join = lambda a, b: joins.left_join_streams(a, b, "tx", "pt", "rt", "10 seconds")
    got = carried.joined(l.stream(), r.stream(), "tx", ("pt", "rt"), (l.delay, r.delay), ("-10 seconds", "10 seconds"), join, "left", "l", "r_")
    assert rows_of(got, *got.columns) == rows_of(join(left, right), *got.columns)


def test_carried_rows_look_at_rows_in_their_reach_only(spark, monkeypatch):
    """What is carried is looked for among the rows in its reach only."""
    seen, reach = [], joins.in_reach
    monkeypatch.setattr(carried.joins, "in_reach", lambda *args: seen.append(args[1].count()) or reach(*args))
    pays, receipts = (make(spark, [(i, f"t{i % 50}", i, None, "p") for i in range(400)]).select(
        F.col("k").alias("tx"), F.col("t").alias(time)) for time in ("pt", "rt"))
    l, r = (write_replay(df, time) for df, time in ((pays, "pt"), (receipts, "rt")))
    join = lambda a, b: joins.left_join_streams(a, b, "tx", "pt", "rt", "10 seconds")
    args = ("tx", ("pt", "rt"), (l.delay, r.delay), ("-10 seconds", "10 seconds"), join, "near")
    carried.joined(l.stream(), r.stream(), *args, "l", "r_")
    assert len(seen) == 4 and max(seen) <= 40


def test_pairs_are_numbered_in_one_walk(spark, monkeypatch):
    """Both sides of a key go through one window, keys that are null through none; what is carried is looked up once per micro-batch."""
    walks, real = [], carried.sequence

    def walked(rows, keys, order):
        walks.append((keys, rows.where("k is null").count()))
        return real(rows, keys, order)

    monkeypatch.setattr(carried, "sequence", walked)
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2], i, None, "lr"[i // 7 % 2]) for i in range(40)]
    tagged = lambda df: df.select("k", "n", F.col("kind").alias("side"))
    got = carried.match_pairs(tagged(arrivals(spark, rows)), "k", "n")
    batch = tagged(make(spark, rows))
    left, right = (batch.where(F.col("side") == s).select("k", F.col("n").alias(c)) for s, c in (("l", "ln"), ("r", "rn")))
    assert rows_of(got, "k", "left_n", "right_n") == rows_of(joins.match_join(left, right, "k", "ln", "rn"), "k", "ln", "rn")
    assert walks == [(["k"], 0)] * 4

"""Streaming forms over several micro-batches against the batch forms."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators import aggregates, alerts, joins, over, patterns, topn, watermark, windows
from millrace.operators import sequence as seq
from millrace.session import scratch
from millrace.sources import readers
from millrace.streaming import batches, folds, keyed, sinks
from millrace.streaming.runtime import (
    run_batches, run_to_files, run_to_upsert, state_settings, table_stream, unix_times, wall, with_event_time,
)

KEYS, ARRIVAL = ["k"], ["n"]


@pytest.fixture(scope="module")
def data(spark):
    """Sixty rows in event-time order, three keys, in four files, and a far-future sentinel file."""
    rows = [(i, f"k{i * 7 % 3}", i * 2 + (i % 5), float(i * 37 % 50), ["fail", "ok", "fail"][i * 5 % 3 if i % 4 else 0]) for i in range(60)]
    rows = sorted(rows, key=lambda r: r[2])
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    return rows


def make(spark, rows):
    df = spark.createDataFrame(rows, "n long, k string, s long, v double, kind string")
    return df.withColumn("t", F.timestamp_seconds(F.col("s") + 100_000).cast("timestamp_ntz"))


def batch_of(spark, data):
    return make(spark, data)


def stream_of(spark, data, sentinel=True, files=4, order=None):
    """The rows as a stream of several files, one per micro-batch."""
    path = scratch(spark, "input")
    rows = order or data
    size = -(-len(rows) // files)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    if sentinel:
        parts.append([(10_000, "end", 1_000_000, 0.0, "end")])
    for part in parts:
        make(spark, part).coalesce(1).write.mode("append").parquet(path)
    schema = make(spark, data[:1]).schema
    return table_stream(spark, path + "/", schema, files_per_batch=1)


def test_a_settled_key_is_forgotten():
    class Value:
        def __init__(self):
            self.now = None

        def exists(self):
            return self.now is not None

        def get(self):
            return self.now

        def update(self, values):
            self.now = tuple(values)

        def clear(self):
            self.now = None

    row = lambda n, side: {"n": n, "side": side, "at": n}
    one = keyed.InArrivalOrder(folds.MatchPair("side", "at"), None, ["left_at", "right_at", "completed_by"], ["k"], None, arrival="n")
    one.kept = Value()
    assert list(one.handleInputRows(("a",), iter([row(1, "l")]), None)) == [] and one.kept.exists()
    assert len(list(one.handleInputRows(("a",), iter([row(2, "r")]), None))) == 1 and not one.kept.exists()


def test_folds_in_event_time(spark, data):
    """Rows arrive shuffled inside the watermark delay; results equal the ordered batch form."""
    batch = batch_of(spark, data)
    # Neighbouring rows swap places, across file borders too.
    order = list(data)
    for i in range(1, len(order) - 1, 2):
        order[i], order[i + 1] = order[i + 1], order[i]
    stream = with_event_time(stream_of(spark, data, order=order), "t", "20 seconds")

    def folded(fold, **columns):
        rows = stream.select("n", "k", "t", *[c.alias(a) for a, c in columns.items()])
        return run_to_files(keyed.fold_event_time(rows, KEYS, "t", "n", fold), "fold").where("k <> 'end'")

    fails = F.col("kind") == "fail"
    found = folded(folds.Consecutive("hit", keyed.AT, "n", 2, micros("8 seconds")), hit=fails)
    want = patterns.pattern_consecutive(batch, KEYS, "t", "n", fails, 2, "8 seconds")
    assert rows_of(found, "first_arrival", "arrival") == rows_of(want, "first_n", "n")


def test_built_in_windows(spark, data):
    batch = batch_of(spark, data)
    stream = with_event_time(stream_of(spark, data), "t", "5 seconds")
    for form in (
        lambda d: windows.tumble(d, KEYS, "t", "10 seconds", c=F.count("*")),
        lambda d: windows.slide(d, KEYS, "t", "10 seconds", "4 seconds", c=F.count("*")),
        lambda d: windows.session(d, KEYS, "t", "7 seconds", c=F.count("*")),
    ):
        got = unix_times(run_to_files(form(stream), "windows").where("k <> 'end'"), "window_start")
        assert rows_of(got, "k", "window_start", "c") == rows_of(form(batch), "k", "window_start", "c")


def test_eager_window_updates(spark, data):
    stream = with_event_time(stream_of(spark, data), "t", "5 seconds")
    counted = windows.tumble(stream, KEYS, "t", "20 seconds", c=F.count("*"))
    newest = unix_times(run_to_upsert(counted, ["k", "window_start"], "eager").where("k <> 'end'"), "window_start")
    want = windows.tumble(batch_of(spark, data), KEYS, "t", "20 seconds", c=F.count("*"))
    assert rows_of(newest, "k", "window_start", "c") == rows_of(want, "k", "window_start", "c")


def test_allowed_lateness_refires(spark):
    """A window whose result was given out is given out again when a late row is still allowed."""
    rows = [(0, "a", 1, 1.0, "x"), (1, "a", 12, 1.0, "x"), (2, "a", 3, 1.0, "x"), (3, "a", 40, 1.0, "x")]
    # Delay and lateness together form the watermark of the updating query.
    stream = with_event_time(stream_of(spark, rows, sentinel=False), "t", "15 seconds")
    fired = []

    def each(batch, batch_id):
        fired.extend((batch_id, r.window_start, r.c) for r in batch.collect())

    run_batches(windows.tumble(stream, KEYS, "t", "10 seconds", c=F.count("*")), each, scratch(spark, "refire"), "update")
    first = min(s for _, s, _ in fired)
    assert [c for _, s, c in fired if s == first] == [1, 2]


def test_running_over_the_whole_stream(spark, data):
    batch, stream = batch_of(spark, data), stream_of(spark, data, sentinel=False)
    got = batches.running_count(stream.select("n"), "n")
    assert rows_of(got, "n", "nth") == [(i, i + 1) for i in range(60)]
    got = batches.running_distinct(stream.select("n", "v"), "v", "n")
    assert rows_of(got, "n", "uv") == rows_of(aggregates.running_distinct(batch, "v", "n"), "n", "uv")
    got = batches.running_total(stream.select("n", "v"), "n", F.col("v"), "total")
    assert rows_of(got, "n", "total") == rows_of(over.over_unbounded_global(batch, ARRIVAL, "v", "total"), "n", "total")


def test_late_rows_are_kept_apart(spark):
    rows = [(0, "a", 1, 0.0, "x"), (1, "a", 30, 0.0, "x"), (2, "a", 3, 0.0, "x"), (3, "a", 29, 0.0, "x")]
    main, side = batches.split_late(stream_of(spark, rows, sentinel=False), "t", "5 seconds", "2 seconds")
    assert rows_of(side, "n") == [(2,)] and rows_of(main, "n") == [(0,), (1,), (3,)]
    want = watermark.late_side_output(make(spark, rows), "t", "n", "5 seconds", "2 seconds")[1]
    assert rows_of(side, "n") == rows_of(want, "n")


def test_a_repeated_batch_changes_nothing(spark, data):
    """The driver dies after a batch was written but before it was recorded."""
    stream = stream_of(spark, data, sentinel=False).select("n", "k", "v")
    base, calls = scratch(spark, "again"), []
    from millrace.sinks.writers import UpsertTable

    target = UpsertTable(spark, f"{base}/table", KEYS, ARRIVAL)

    def each(batch, batch_id):
        target.merge(batch, batch_id)
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run_batches(stream, each, base)
    run_batches(stream, each, base)
    assert calls == [0, 1, 1, 2, 3]
    want = aggregates.latest_per_key(batch_of(spark, data).select("n", "k", "v"), KEYS, ARRIVAL)
    assert rows_of(target.read(), "k", "n", "v") == rows_of(want, "k", "n", "v")


def test_stream_joins(spark):
    left_rows = [(i, f"t{i}", i * 10, 0.0, "pay") for i in range(8)]
    right_rows = [(i, f"t{i}", i * 10 + d, 0.0, "receipt") for i, d in [(0, 3), (1, 30), (2, -4), (4, 10), (5, 0)]]
    right_rows.append((9, "t9", 61, 0.0, "receipt"))

    def side(rows, name, delay="2 seconds"):
        timed = with_event_time(stream_of(spark, rows, files=3), "t", delay)
        return timed.select(F.col("k").alias("tx"), F.col("t").alias(name))

    left, right = side(left_rows, "pt"), side(right_rows, "rt")
    inner = run_to_files(joins.interval_join(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", False), "inner")
    assert rows_of(inner.where("tx <> 'end'"), "tx") == [("t0",), ("t2",), ("t4",), ("t5",)]
    outer = run_to_files(
        joins.reconcile_outer(left, right, "tx", "pt", "rt", "-5 seconds", "10 seconds", bucketed=False), "outer"
    )
    batch = [make(spark, r).select(F.col("k").alias("tx"), F.col("t").alias(c)) for r, c in ((left_rows, "pt"), (right_rows, "rt"))]
    want = joins.reconcile_outer(*batch, "tx", "pt", "rt", "-5 seconds", "10 seconds")
    assert rows_of(outer.where("tx <> 'end'"), "tx", "kind") == rows_of(want, "tx", "kind")
    kept = run_to_files(joins.left_join_streams(left, right, "tx", "pt", "rt", "10 seconds"), "left")
    kept = kept.where("tx <> 'end'")
    assert kept.count() == 8
    assert rows_of(kept.where("r_tx is not null"), "tx") == [("t0",), ("t2",), ("t4",), ("t5",)]


def test_dedup_within_watermark(spark, data):
    stream = with_event_time(stream_of(spark, data), "t", "30 seconds").select("k", "t", "kind")
    got = run_to_files(stream.dropDuplicatesWithinWatermark(["k", "kind"]).select("k", "kind"), "dedup")
    assert {tuple(r) for r in got.collect()} >= {(r[1], r[4]) for r in data}


def test_console_and_file_sinks(spark, data):
    stream = stream_of(spark, data, sentinel=False)
    with state_settings(spark):
        writer = sinks.to_console(stream.groupBy("kind").count(), mode="complete").trigger(availableNow=True)
        shown = writer.option("checkpointLocation", scratch(spark, "console")).start()
        shown.awaitTermination()
    assert shown.lastProgress["batchId"] == 3 and "Console" in shown.lastProgress["sink"]["description"]
    base = scratch(spark, "csv")
    sinks.to_csv(stream.select("n", "k"), f"{base}/data", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema("n long, k string").csv(f"{base}/data").count() == 60


def test_connector_options():
    from millrace.sinks.writers import jdbc_options

    options = readers.kafka_options("host:9092", "sensor", starting="earliest", group="g", maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "sensor", "startingOffsets": "earliest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "5",
    }
    assert jdbc_options("jdbc:x", "t", driver="d", batch_rows=7) == {"url": "jdbc:x", "dbtable": "t", "batchsize": "7", "driver": "d"}


def test_wall_time_round_trip(spark, data):
    df = batch_of(spark, data)
    back = df.select("t", F.timestamp_micros(seq.ticks(df, "t")).alias("i")).select("t", wall("i").alias("u"))
    assert back.where("t <> u").count() == 0

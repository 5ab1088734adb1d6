"""Queries that read the shared tables as streams.

Each runs to the end of the present input and returns what its sink holds.
Where closing by the watermark is itself the operator, its SQL twin is limited to
the same horizon: the largest event time (in whole milliseconds, as Spark keeps
it) minus the delay. All others are replayed in several micro-batches and
flushed at the end of the input, so that nothing is cut off.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.udfs import average
from millrace.operators import aggregates as agg
from millrace.operators import joins, topn, windows
from millrace.operators import sequence as seq
from millrace.operators.project import tagged_union, union_all
from millrace.plans import analytics
from millrace.plans.keyed import (
    CONSECUTIVE_SQL, FAIL_PAIRS_SQL, FOLLOWED_SQL, RUNNING_SQL, UV_SQL, burst_sql, item,
)
from millrace.plans.registry import ORACLES, SHIFTED_SQL, events, query, shifted_events, table
from millrace.plans.timed import HOT_ITEMS_SQL, PAYS, bucket, session_sql, sliding
from millrace.session import scratch
from millrace.sources import readers, schemas
from millrace.streaming import batches, carried, keyed, sinks
from millrace.streaming.replay import write_replay
from millrace.streaming.runtime import (
    run_to_files, run_to_upsert, state_settings, table_stream, unix_times, with_event_time,
)


def event_stream(spark, sf_dir):
    return table_stream(spark, f"{sf_dir}/events.parquet", schemas.EVENT)


def timed_stream(spark, sf_dir, delay):
    return with_event_time(event_stream(spark, sf_dir), "ts", delay)


def horizon(delay: str, source: str = "events") -> str:
    return f"SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {delay} FROM {source}"


def replayed(spark, sf_dir, *columns, beyond="0 seconds", exact=False):
    """The events in four time-ordered steps and a last row that lets everything go."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", *columns)
    return write_replay(rows, "ts").flush(beyond, exact=exact)


def arriving(spark, sf_dir, time="ts", *columns):
    """The events in four steps of their arrival, with times that may be out of order."""
    rows = (shifted_events(spark, sf_dir) if time == "et" else table(spark, sf_dir, "events")).select("event_id", time, *columns)
    n = rows.agg(F.max("event_id")).first()[0] + 1
    return write_replay(rows, time, step=F.expr(f"event_id * 4 div {n}")).stream()


def times(rows, *columns):
    return unix_times(rows, *columns)


def micro_times(rows, **columns):
    """Columns of microseconds as zone-less times under new names."""
    start = "timestamp_ntz'1970-01-01 00:00:00'"
    added = {new: F.expr(f"timestampadd(MICROSECOND, `{old}`, {start})") for new, old in columns.items()}
    return rows.withColumns(added).drop(*[old for new, old in columns.items() if new != old])


# ------------------------------------------------------------------- sources and sinks

@query("src_stream_lines", ORACLES["src_text"])
def src_stream_lines(spark, sf_dir):
    path = scratch(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = readers.stream_lines(spark, path)
    counts = lines.groupBy(F.length("value").cast("bigint").alias("chars")).agg(F.count(F.lit(1)).alias("n"))
    return run_to_upsert(counts, ["chars"], "lines")


@query("src_kafka", """
    SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def src_kafka(spark, sf_dir):
    # The connector is not installed here: the same decoding over messages that arrive as files.
    path = scratch(spark, "messages")
    message = F.to_json(F.struct("event_id", "user_id", "event_type", item().alias("k")))
    table(spark, sf_dir, "events").select(message.alias("value")).write.text(path)
    decoded = readers.decode_json(
        readers.stream_lines(spark, path), "event_id bigint, user_id bigint, event_type string, k bigint"
    )
    return run_to_files(decoded, "kafka")


@query("stream_sink_csv", ORACLES["sink_file_csv"])
def stream_sink_csv(spark, sf_dir):
    errors = event_stream(spark, sf_dir).where("event_type = 'error'").select("user_id", "event_type", "value")
    return run_to_files(errors, "csv", form="csv")


@query("stream_sink_upsert", ORACLES["sink_upsert"])
def stream_sink_upsert(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("user_id", "event_type", "value", "event_id")
    return run_to_upsert(rows, ["user_id"], "upsert", order=["event_id"], mode="append")


@query("stream_insert_select", ORACLES["insert_select"])
def stream_insert_select(spark, sf_dir):
    base = scratch(spark, "insert")
    name = "stream_sink_" + base[-32:]
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, user_id BIGINT, value DOUBLE) USING parquet LOCATION '{base}/data'")
    bought = event_stream(spark, sf_dir).where("event_type = 'purchase'").select("event_id", "user_id", "value")
    with state_settings(spark):
        writer = sinks.to_table(bought, name, f"{base}/checkpoint").trigger(availableNow=True)
        writer.toTable(name).awaitTermination()
    return spark.table(name)


@query("stream_split_stream", ORACLES["split_stream"])
def stream_split(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("event_id", "user_id", "value")
    main, side = batches.split_stream(rows, F.col("value") >= 30, ["event_id", "value"])
    both = main.withColumn("output", F.lit("main")).unionByName(
        side.withColumn("output", F.lit("side")), allowMissingColumns=True
    )
    return both.withColumn("user_id", F.coalesce("user_id", F.lit(-1)))


# --------------------------------------------------------- watermarks and time windows

def tumbled(spark, sf_dir, delay):
    rows = timed_stream(spark, sf_dir, delay)
    return windows.tumble(rows, ["event_type"], "ts", "6 hours", n=F.count(F.lit(1)), total=F.sum("value"))


def closed_windows(result):
    return times(result.withColumn("total", F.round("total", 4)), "window_start", "window_end")


def closed_sql(delay: str) -> str:
    return f"""
    SELECT event_type, {bucket('6 HOUR')} AS window_start, {bucket('6 HOUR')} + INTERVAL 6 HOUR AS window_end,
           count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2, 3
    HAVING {bucket('6 HOUR')} + INTERVAL 6 HOUR <= ({horizon(delay)})"""


@query("wm_monotonic", closed_sql("0 SECOND"))
def wm_monotonic(spark, sf_dir):
    return closed_windows(run_to_files(tumbled(spark, sf_dir, "0 seconds"), "ascending"))


@query("wm_bounded", closed_sql("10 HOUR"))
def wm_bounded(spark, sf_dir):
    return closed_windows(run_to_files(tumbled(spark, sf_dir, "10 hours"), "bounded"))


@query("wm_periodic_custom", closed_sql("2 DAY"))
def wm_periodic_custom(spark, sf_dir):
    # The rule "largest time so far minus a delay, renewed from time to time" is the built-in one.
    return closed_windows(run_to_files(tumbled(spark, sf_dir, "2 days"), "periodic"))


@query("append_output", closed_sql("1 HOUR"))
def append_output(spark, sf_dir):
    return closed_windows(run_to_files(tumbled(spark, sf_dir, "1 hour"), "append", mode="append"))


@query("wm_ddl", f"""
    SELECT {bucket('1 DAY')} AS window_start, count(*) AS n FROM events GROUP BY 1
    HAVING {bucket('1 DAY')} + INTERVAL 1 DAY <= (
      SELECT date_trunc('second', max(ts)) - INTERVAL 5 SECOND FROM events)""")
def wm_ddl(spark, sf_dir):
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    readers.register_source(
        spark, "declared_stream", schemas.EVENT, {"format": "parquet", "path": f"{sf_dir}/events.parquet*"},
        event_time=("rt", F.timestamp_seconds(seconds)), delay="5 seconds", stream=True,
    )
    days = spark.sql(
        "SELECT window(rt, '1 day').start AS window_start, count(*) AS n FROM declared_stream GROUP BY window(rt, '1 day')"
    )
    return times(run_to_files(days, "ddl"), "window_start")


@query("wm_multi_input", f"""
    WITH h AS (SELECT least(({horizon('0 SECOND', "(SELECT ts FROM events WHERE event_type = 'view')")}),
                            ({horizon('3 DAY', "(SELECT ts FROM events WHERE event_type = 'click')")})) AS h)
    SELECT {bucket('1 DAY')} AS window_start, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1
    HAVING {bucket('1 DAY')} + INTERVAL 1 DAY <= (SELECT h FROM h)""")
def wm_multi_input(spark, sf_dir):
    # Two inputs with their own watermarks; the smaller one rules the query.
    rows = event_stream(spark, sf_dir).select("ts", "event_type")
    views = with_event_time(rows.where("event_type = 'view'"), "ts", "0 seconds")
    clicks = with_event_time(rows.where("event_type = 'click'"), "ts", "3 days")
    both = views.unionByName(clicks)
    days = windows.tumble(both, [], "ts", "1 day", n=F.count(F.lit(1))).drop("window_end")
    return times(run_to_files(days, "inputs"), "window_start")


@query("stream_tumble_et", ORACLES["tumble_all"])
def stream_tumble_et(spark, sf_dir):
    rows = timed_stream(spark, sf_dir, "1 hour")
    counted = windows.tumble(rows, [], "ts", "6 hours", n=F.count(F.lit(1)), total=F.sum("value"))
    return closed_windows(run_to_upsert(counted, ["window_start", "window_end"], "tumble"))


@query("stream_slide_et", ORACLES["slide_pt"])
def stream_slide_et(spark, sf_dir):
    rows = timed_stream(spark, sf_dir, "1 hour")
    summed = windows.slide(rows, ["user_id"], "ts", "5 hours", "2 hours", total=F.sum("value"))
    return closed_windows(run_to_upsert(summed, ["user_id", "window_start", "window_end"], "slide"))


@query("stream_session_et", session_sql("ts", "events", 12))
def stream_session_et(spark, sf_dir):
    rows = replayed(spark, sf_dir, "value", beyond="1 day").timed()
    sessions = windows.session(rows, ["user_id"], "ts", "12 hours", n=F.count(F.lit(1)), total=F.sum("value"))
    return closed_windows(run_to_files(sessions, "session"))


@query("stream_salted_two_phase", f"SELECT {bucket('6 HOUR')} AS window_start, count(*) AS n FROM events GROUP BY 1")
def stream_salted_two_phase(spark, sf_dir):
    rows = replayed(spark, sf_dir, beyond="1 day").timed().select("ts", F.pmod(F.xxhash64("event_id"), F.lit(8)).alias("salt"))
    partial = rows.groupBy("salt", F.window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("c"))
    whole = partial.groupBy("w").agg(F.sum("c").alias("n")).select(F.col("w.start").alias("window_start"), "n")
    return times(run_to_files(whole, "salted"), "window_start")


@query("stream_uv_window", UV_SQL)
def stream_uv_window(spark, sf_dir):
    views = timed_stream(spark, sf_dir, "1 hour").where("event_type = 'view'")
    placed = views.select("user_id", F.window("ts", "1 hour").alias("w")).dropDuplicates(["user_id", "w"])
    pairs = run_to_files(placed.select("user_id", F.col("w.start").alias("window_start")), "uv")
    return times(pairs.groupBy("window_start").agg(F.count(F.lit(1)).alias("uv")), "window_start")


@query("stream_distinct_values", "SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct_values(spark, sf_dir):
    return run_to_files(event_stream(spark, sf_dir).select("user_id", "event_type").dropDuplicates(), "distinct")


@query("stream_table_group_agg", """
    SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 8) AS average FROM events GROUP BY 1""")
def stream_table_group_agg(spark, sf_dir):
    rows = event_stream(spark, sf_dir)
    grouped = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), average("value").alias("average")
    )
    kept = run_to_upsert(grouped, ["user_id"], "grouped")
    return kept.select("user_id", "n", F.round("total", 4).alias("total"), F.round("average", 8).alias("average"))


@query("stream_running_max", ORACLES["running_max"])
def stream_running_max(spark, sf_dir):
    rows = carried.running(
        arriving(spark, sf_dir, "ts", "user_id", "value"), ["user_id"], "event_id", "running-max",
        max_value=seq.highest("value"), first=seq.earliest(F.struct("ts")),
    )
    return rows.select("event_id", "user_id", "max_value", F.col("first.ts").alias("first_ts"))


@query("stream_running_max_by", ORACLES["running_max_by"])
def stream_running_max_by(spark, sf_dir):
    rows = carried.running(
        arriving(spark, sf_dir, "ts", "user_id", "value"), ["user_id"], "event_id", "running-max-by",
        best=seq.highest(F.struct("value", "event_id", "ts")),
    )
    best = F.col("best")
    return rows.select(
        "event_id", "user_id", best["value"].alias("best_value"), best["event_id"].alias("best_id"), best["ts"].alias("best_ts"))


@query("stream_running_reduce", ORACLES["running_reduce"])
def stream_running_reduce(spark, sf_dir):
    rows = carried.running(
        arriving(spark, sf_dir, "ts", "user_id", "value"), ["user_id"], "event_id", "running-reduce", highest=seq.highest("value"))
    return rows.select("event_id", "user_id", "ts", "highest")


@query("stream_hot_items", HOT_ITEMS_SQL)
def stream_hot_items(spark, sf_dir):
    views = timed_stream(spark, sf_dir, "1 hour").where("event_type = 'view'").select("ts", item().alias("item"))
    counts = views.groupBy("item", F.window("ts", "1 hour", "5 minutes")["end"].alias("window_end")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    ranked = batches.rank_updates(counts, ["item"], "window_end", ["cnt", "item"], 5)
    return times(ranked, "window_end").select("window_end", "item", "cnt", "row_num")


# --------------------------------------------------------------- running over the stream

@query("stream_running_count", ORACLES["running_count"])
def stream_running_count(spark, sf_dir):
    views = event_stream(spark, sf_dir).where("event_type = 'view'").select("event_id")
    return batches.running_count(views, "event_id")


@query("stream_running_distinct", ORACLES["running_distinct"])
def stream_running_distinct(spark, sf_dir):
    return batches.running_distinct(event_stream(spark, sf_dir).select("event_id", "user_id"), "user_id", "event_id")


@query("stream_over_unbounded_global", ORACLES["over_unbounded_global"])
def stream_over_unbounded_global(spark, sf_dir):
    rows = batches.running_total(event_stream(spark, sf_dir).select("event_id", "value"), "event_id", F.col("value"), "total")
    return rows.select("event_id", F.round("total", 3).alias("total"))


@query("stream_control_broadcast", ORACLES["control_broadcast"])
def stream_control_broadcast(spark, sf_dir):
    # Two streams of their own over one replay: a batch brings what arrived on both in the same stretch.
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    replay = write_replay(rows, "event_id")
    control = replay.stream().where("event_type = 'signup'").select(
        "event_id", F.lit(True).alias("is_control"), (F.col("user_id") % 4).cast("string").alias("switch"))
    data = replay.stream().where("event_type <> 'signup'").select(
        "event_id", F.lit(False).alias("is_control"), F.lit(None).cast("string").alias("switch"))
    switched = carried.label_by_control(data.unionByName(control), "event_id", F.col("is_control"), F.col("switch"), "switch_value")
    value = F.col("switch_value")
    label = F.when(value == "1", "switched to 1").when(value == "2", "switched to 2").otherwise("switched to other")
    return switched.select("event_id", label.alias("label"))


# --------------------------------------------------- carried state, arrival order

USER = ["user_id"]


def user_events(spark, sf_dir):
    return event_stream(spark, sf_dir).select("event_id", "user_id", "value")


@query("stream_keyed_profile", f"""
    SELECT event_id, user_id, count(*) OVER {RUNNING_SQL} AS n, round(sum(value) OVER {RUNNING_SQL}, 4) AS total,
           max(value) OVER {RUNNING_SQL} AS highest, round(avg(value) OVER {RUNNING_SQL}, 8) AS average,
           lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events""")
def stream_keyed_profile(spark, sf_dir):
    rows = carried.running(
        user_events(spark, sf_dir), USER, "event_id", "profile", n=seq.tally(), total=seq.total("value"),
        known=seq.tally(F.col("value").isNotNull()), highest=seq.highest("value"), previous=seq.previous("value"),
    )
    average = F.round(F.col("total") / F.col("known"), 8).alias("average")
    return rows.select("event_id", "user_id", "n", F.round("total", 4).alias("total"), "highest", average, "previous")


def slid(spark, sf_dir, size, label):
    total = lambda w: F.sum("value").over(w.rowsBetween(-(size - 1), 0))
    rows = carried.sliding_rows(user_events(spark, sf_dir), USER, "event_id", size, label, total=total)
    return rows.withColumn("total", F.round("total", 4))


@query("stream_count_tumble", ORACLES["count_tumble"])
def stream_count_tumble(spark, sf_dir):
    full = slid(spark, sf_dir, 5, "count-tumble").where("nth % 5 = 0")
    return full.select("user_id", F.expr("nth div 5 - 1").alias("window_no"), "total")


@query("stream_count_slide", ORACLES["count_slide"])
def stream_count_slide(spark, sf_dir):
    return slid(spark, sf_dir, 5, "count-slide").where("nth % 2 = 0").select("user_id", "event_id", "nth", "total")


@query("stream_count_slide_table", ORACLES["count_slide_table"])
def stream_count_slide_table(spark, sf_dir):
    fires = "nth >= 5 and (nth - 5) % 2 = 0"
    return slid(spark, sf_dir, 5, "count-slide-table").where(fires).select("user_id", "event_id", "nth", "total")


@query("stream_over_rows_bounded", ORACLES["over_rows_bounded"])
def stream_over_rows_bounded(spark, sf_dir):
    return slid(spark, sf_dir, 3, "over-rows").select("event_id", "user_id", "total")


@query("stream_prev_value_jump", ORACLES["prev_value_jump"])
def stream_prev_value_jump(spark, sf_dir):
    rows = carried.running(user_events(spark, sf_dir), USER, "event_id", "jump", previous_value=seq.previous("value"))
    return rows.where("abs(value - previous_value) > 10").select("event_id", "user_id", "value", "previous_value")


@query("stream_running_top3", """
    SELECT event_id, user_id, top1, top2, top3 FROM (""" + ORACLES["running_top3"] + ")")
def stream_running_top3(spark, sf_dir):
    rows = carried.running_top(user_events(spark, sf_dir), USER, "event_id", "value", 3)
    return rows.select("event_id", "user_id", "top1", "top2", "top3")


@query("stream_udtaf_top2", ORACLES["udtaf_top2"])
def stream_udtaf_top2(spark, sf_dir):
    rows = carried.running_top(user_events(spark, sf_dir), USER, "event_id", "value", 2, "top2")
    # A row changes the table aggregate when it is among the two itself; the newest such row holds the present result.
    changed = rows.where("event_id in (top1_event_id, top2_event_id)")
    newest = agg.latest_per_key(changed.select("user_id", "event_id", "top1", "top2"), USER, ["event_id"])
    ranks = F.array(*[F.struct(F.col(f"top{i}").alias("value"), F.lit(f"TOP{i}").alias("rank")) for i in (1, 2)])
    return newest.select("user_id", F.inline(ranks)).where("value is not null")


@query("stream_changelog", ORACLES["changelog"])
def stream_changelog(spark, sf_dir):
    rows = carried.changelog(user_events(spark, sf_dir), USER, "event_id", {"n": seq.tally(), "total": seq.total("value")})
    return rows.withColumn("total", F.round("total", 4))


@query("stream_login_fail_pairs", FAIL_PAIRS_SQL)
def stream_login_fail_pairs(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("event_id", "user_id", "ts", (F.col("event_type") == "error").alias("fails"))
    rows = carried.running(rows, USER, "event_id", "pairs", before=seq.previous(F.struct("fails", "ts")))
    gap = F.expr("abs(timestampdiff(MICROSECOND, before.ts, ts)) <= 21600000000")
    pairs = rows.where(F.col("fails") & F.col("before.fails") & gap)
    return pairs.select("event_id", "user_id", "ts", F.col("before.ts").alias("previous_time"))


def clicks_of_day(spark, sf_dir, label):
    """Rows with their number per user, type and local day; days gone by are forgotten."""
    day = F.to_date(F.expr("ts + interval 8 hours")).alias("local_day")
    rows = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", day)
    return carried.running(
        rows, ["user_id", "event_type", "local_day"], "event_id", label, ttl=("local_day", "2 days"), nth=seq.tally())


@query("stream_blacklist_filter", """
    WITH c AS (SELECT user_id, event_type, event_id, row_number() OVER (
        PARTITION BY user_id, event_type, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY event_id) AS nth FROM events)
    SELECT user_id, event_type, event_id, nth, false AS is_alert FROM c WHERE nth < 2
    UNION ALL SELECT user_id, event_type, event_id, nth, true FROM c WHERE nth = 2""")
def stream_blacklist_filter(spark, sf_dir):
    judged = clicks_of_day(spark, sf_dir, "blacklist").where("nth <= 2")
    return judged.select("user_id", "event_type", "event_id", "nth", (F.col("nth") == 2).alias("is_alert"))


@query("stream_match_join", """
    SELECT c_custkey AS k, CAST(round(c_acctbal * 100) AS BIGINT) AS left_at, CAST(round(s_acctbal * 100) AS BIGINT) AS right_at,
           CASE WHEN c_acctbal > s_acctbal THEN 'left' ELSE 'right' END AS completed_by
    FROM customer JOIN supplier ON c_custkey = s_suppkey""")
def stream_match_join(spark, sf_dir):
    # Two inputs that share keys 1:1; the balance in cents stands for the arrival.
    def side(name, key, balance):
        path = f"{sf_dir}/{name}.parquet"
        rows = table_stream(spark, path, spark.read.parquet(path).schema)
        return rows.select(F.col(key).alias("k"), F.round(F.col(balance) * 100).cast("bigint").alias("at"))

    both = tagged_union(side("customer", "c_custkey", "c_acctbal"), side("supplier", "s_suppkey", "s_acctbal"))
    return carried.match_pairs(both, "k", "at")


@query("stream_eager_trigger", ORACLES["eager_trigger"])
def stream_eager_trigger(spark, sf_dir):
    # Every row gives its window's new result; windows two days back are forgotten.
    start = F.window("ts", "1 day")["start"].cast("timestamp_ntz").alias("window_start")
    rows = arriving(spark, sf_dir, "ts", "user_id").select("event_id", "user_id", start)
    return carried.running(rows, ["user_id", "window_start"], "event_id", "eager", ttl=("window_start", "2 days"), n=seq.tally())


# ------------------------------------------------------- carried state, event-time order

@query("stream_over_unbounded_et", ORACLES["over_unbounded_et"])
def stream_over_unbounded_et(spark, sf_dir):
    # Times cut to the day, so that there are peers; they wait until the watermark has passed the day's first instant.
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("rt"))
    replay = write_replay(rows, "rt").flush("1 day")
    counted = carried.over_unbounded(replay.stream(), USER, "rt", "1 day", n=seq.tally())
    return counted.where("event_id is not null").select("event_id", "user_id", "n")


@query("stream_pattern_consecutive", CONSECUTIVE_SQL)
def stream_pattern_consecutive(spark, sf_dir, replay=None):
    replay = replay or replayed(spark, sf_dir, "event_type")
    found = carried.consecutive(replay.stream(), USER, "ts", "event_id", replay.delay, F.col("event_type") == "error", 2, "12 hours")
    return found.select("event_id", "user_id", "ts", "first_time", "first_event_id")


@query("stream_pattern_followed_by", FOLLOWED_SQL)
def stream_pattern_followed_by(spark, sf_dir, replay=None):
    replay = replay or replayed(spark, sf_dir, "event_type", beyond="2 days")
    found = carried.followed_by(
        replay.stream(), USER, "ts", "event_id", replay.delay,
        F.col("event_type") == "signup", F.col("event_type") == "purchase", "2 days",
    )
    return found.withColumn("then_event_id", F.coalesce("then_event_id", F.lit(-1)))


@query("stream_pattern_timeout", ORACLES["pattern_timeout"])
def stream_pattern_timeout(spark, sf_dir):
    ended = stream_pattern_followed_by(spark, sf_dir).where("kind = 'timeout'")
    return ended.select("user_id", "begin_event_id", "begin_time", "timeout_time")


@query("stream_no_drop_alert", ORACLES["no_drop_alert"])
def stream_no_drop_alert(spark, sf_dir):
    replay = replayed(spark, sf_dir, "value", exact=True)
    found = carried.no_drop(replay.stream(), USER, "ts", "event_id", replay.delay, "value", "12 hours")
    return micro_times(found, since="since", alert_time="alert_at")


@query("stream_login_fail_burst", burst_sql(6))
def stream_login_fail_burst(spark, sf_dir, replay=None):
    replay = replay or replayed(spark, sf_dir, "event_type", beyond="6 hours")
    return carried.bursts(replay.stream(), USER, "ts", "event_id", replay.delay, F.col("event_type") == "error", "6 hours")


@query("stream_order_pay_monitor", ORACLES["order_pay_monitor"])
def stream_order_pay_monitor(spark, sf_dir, replay=None):
    replay = replay or replayed(spark, sf_dir, "event_type", beyond="2 days")
    return carried.order_pay(
        replay.stream(), "user_id", "ts", "event_id", replay.delay,
        F.col("event_type") == "signup", F.col("event_type") == "purchase", "2 days",
    )


# --------------------------------------------------------------- late rows, re-fired windows

def late_cte(delay: int) -> str:
    """The four batches of the arrivals, the watermark each is judged by (``old``) and the one behind it (``mark``)."""
    return f"""
    WITH e AS (SELECT *, {SHIFTED_SQL} AS et, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS b FROM events),
    marks AS (SELECT b, max(max(et)) OVER (ORDER BY b) - INTERVAL {delay} MINUTE AS mark FROM e GROUP BY b),
    j AS (SELECT e.*, o.mark AS old FROM e LEFT JOIN marks o ON o.b = e.b - 1)"""


def fired_sql(keys: str, starts: str, minutes: int, source: str = "j") -> str:
    """All firings of the windows of an hour, given ``late_cte``."""
    return f"""
    p AS (SELECT {keys}, s AS start, b, count(*) AS n, sum(value) AS total FROM (SELECT *, {starts} AS s FROM {source})
          WHERE old IS NULL OR s + INTERVAL 1 HOUR + INTERVAL {minutes} MINUTE > old GROUP BY ALL),
    w AS (SELECT {keys}, start, min(b) AS first_b FROM p GROUP BY ALL),
    g AS (SELECT w.*, marks.b, mark FROM w JOIN marks ON marks.b >= first_b),
    c AS (SELECT {keys}, start, b, mark, n AS fresh, sum(n) OVER v AS n, sum(total) OVER v AS total,
                 min(CASE WHEN start + INTERVAL 1 HOUR <= mark THEN b END) OVER (PARTITION BY {keys}, start) AS fb
          FROM g LEFT JOIN p USING ({keys}, start, b) WINDOW v AS (PARTITION BY {keys}, start ORDER BY b)),
    fired AS (SELECT *, row_number() OVER (PARTITION BY {keys}, start ORDER BY b) - 1 AS firing FROM c
              WHERE b = fb OR (b > fb AND fresh > 0))"""


@query("stream_allowed_lateness", f"""
    {late_cte(10)}, {fired_sql('event_type', bucket('1 HOUR', 'et'), 90)}
    SELECT event_type, start AS window_start, start + INTERVAL 1 HOUR AS window_end, firing, CAST(n AS BIGINT) AS n,
           round(total, 4) AS total FROM fired""")
def stream_allowed_lateness(spark, sf_dir):
    rows = arriving(spark, sf_dir, "et", "event_type", "value")
    fired, _ = carried.allowed_lateness(rows, ["event_type"], "et", "1 hour", "10 minutes", "90 minutes", value="value")
    shown = micro_times(fired, window_start="start", window_end="stop")
    return shown.withColumn("total", F.round("total", 4))


@query("stream_hot_urls", f"""
    {late_cte(10)},
    u AS (SELECT *, '/item/' || json_extract_string(props, '$.k') AS url FROM j WHERE event_type <> 'click'),
    {fired_sql('url', sliding('1 HOUR', '10 MINUTE', '50 MINUTE', 'et'), 15, 'u')},
    r AS (SELECT url, start + INTERVAL 1 HOUR AS window_end, CAST(n AS BIGINT) AS cnt FROM fired
          QUALIFY row_number() OVER (PARTITION BY url, start ORDER BY firing DESC) = 1)
    SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS row_num FROM r QUALIFY row_num <= 5""")
def stream_hot_urls(spark, sf_dir):
    # Clicks count for the watermark, as in the log, and are left out of the windows' ranking afterwards.
    url = F.when(F.col("event_type") != "click", F.concat(F.lit("/item/"), F.get_json_object("props", "$.k"))).alias("url")
    rows = arriving(spark, sf_dir, "et", "event_type", "props").select("event_id", "et", url)
    fired, _ = carried.allowed_lateness(rows, ["url"], "et", "1 hour", "10 minutes", "15 minutes", step="10 minutes", label="hot-urls")
    newest = agg.latest_per_key(fired.where("url is not null").select("url", "stop", "firing", "n"), ["url", "stop"], ["firing"])
    counts = micro_times(newest.withColumnRenamed("n", "cnt"), window_end="stop").drop("firing")
    return topn.top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col("url").asc()], 5)


def late_sql(starts: str, size: str, lateness: str) -> str:
    return late_cte(10) + f" SELECT event_id, et FROM j WHERE {starts} + INTERVAL {size} + INTERVAL {lateness} <= old"


@query("stream_late_side_output", late_sql(bucket("1 HOUR", "et"), "1 HOUR", "5 MINUTE"))
def stream_late_side_output(spark, sf_dir):
    rows = arriving(spark, sf_dir, "et")
    return batches.split_late(rows, "et", "1 hour", "10 minutes", lateness="5 minutes")[1]


@query("stream_late_side_output_sliding", late_sql(bucket("10 MINUTE", "et"), "30 MINUTE", "0 MINUTE"))
def stream_late_side_output_sliding(spark, sf_dir):
    rows = arriving(spark, sf_dir, "et")
    return batches.split_late(rows, "et", "30 minutes", "10 minutes", step="10 minutes")[1]


# -------------------------------------------------------------------------- stream joins

def sides(spark, sf_dir, beyond):
    """Orders and their lines, each in four time-ordered steps of its own and flushed together."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_shipdate")
    both = write_replay(orders, "o_orderdate"), write_replay(lines, "l_shipdate")
    last = max((at for at in [r.last() for r in both] if at is not None), default=None)
    return tuple(r.flush(beyond, last=last, order_key=-1 - i) for i, r in enumerate(both))


def met(both, bounds, join, label, **how):
    """Orders and lines as streams, joined in each micro-batch."""
    orders, lines = both
    return carried.joined(
        orders.stream(), lines.stream(), "order_key", (orders.time, lines.time), (orders.delay, lines.delay), bounds, join, label, **how)


@query("stream_interval_join", f"SELECT o_orderkey AS order_key, o_orderdate, l_linenumber, l_shipdate FROM {PAYS}")
def stream_interval_join(spark, sf_dir, both=None):
    def join(orders, lines):
        return joins.interval_join(orders, lines, "order_key", "o_orderdate", "l_shipdate", "-5 days", "10 days")

    return met(both or sides(spark, sf_dir, "15 days"), ("-5 days", "10 days"), join, "interval")


@query("stream_reconcile_outer", ORACLES["reconcile_outer"])
def stream_reconcile_outer(spark, sf_dir, both=None):
    def join(orders, lines):
        return joins.reconcile_outer(
            orders, lines, "order_key", "o_orderdate", "l_shipdate", "-5 days", "10 days",
            kinds=("matched", "pay_no_receipt", "receipt_no_pay"),
        )

    kept = met(both or sides(spark, sf_dir, "15 days"), ("-5 days", "10 days"), join, "reconcile", outer="lr")
    return kept.withColumn("l_linenumber", F.coalesce("l_linenumber", F.lit(-1)))


@query("stream_left_join_streams", """
    SELECT o_orderkey AS order_key, o_orderdate, l_shipdate AS r_l_shipdate FROM orders
    LEFT JOIN lineitem ON o_orderkey = l_orderkey
      AND l_shipdate BETWEEN o_orderdate - INTERVAL 10 DAY AND o_orderdate + INTERVAL 10 DAY""")
def stream_left_join_streams(spark, sf_dir):
    def join(orders, lines):
        return joins.left_join_streams(orders, lines, "order_key", "o_orderdate", "l_shipdate", "10 days")

    kept = met(sides(spark, sf_dir, "11 days"), ("-10 days", "10 days"), join, "left", outer="l", prefix="r_")
    return kept.select("order_key", "o_orderdate", "r_l_shipdate")


@query("stream_app_reconcile", ORACLES["app_reconcile"])
def stream_app_reconcile(spark, sf_dir):
    n = F.count(F.lit(1)).alias("n")
    orders, lines = both = sides(spark, sf_dir, "15 days")
    paid = orders.stream().select("order_key", F.col("o_orderdate").alias("at"), F.lit("l").alias("side"))
    came = lines.stream().select("order_key", F.col("l_shipdate").alias("at"), F.lit("r").alias("side"))
    # An order occurs once, so first come, first served pairs it with its first line.
    by_key = carried.match_pairs(paid.unionByName(came), "order_key", "at", label="reconcile-keys")
    return union_all(
        stream_interval_join(spark, sf_dir, both).agg(n).select(F.lit("interval").alias("method"), F.lit("matched").alias("kind"), "n"),
        stream_reconcile_outer(spark, sf_dir, both).groupBy("kind").agg(n).select(F.lit("outer").alias("method"), "kind", "n"),
        by_key.agg(n).select(F.lit("key").alias("method"), F.lit("matched").alias("kind"), "n"),
    )


# --------------------------------------------------------------------- worked analytics

@query("stream_app_word_count", ORACLES["app_word_count"])
def stream_app_word_count(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    texts = table_stream(spark, path, spark.read.parquet(path).schema)
    return run_to_upsert(analytics.word_count(texts, "text"), ["word"], "words")


@query("stream_app_hourly_pv", ORACLES["app_hourly_pv"])
def stream_app_hourly_pv(spark, sf_dir):
    hours = analytics.hourly_pv(timed_stream(spark, sf_dir, "1 hour"), F.col("event_type") == "view", "ts")
    return times(run_to_upsert(hours, ["window_start"], "pv"), "window_start")


@query("stream_app_channel_stats", "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def stream_app_channel_stats(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    texts = table_stream(spark, path, spark.read.parquet(path).schema)
    return run_to_upsert(agg.composite_key_count(texts, ["source", "lang"]), ["source", "lang"], "channels")


@query("stream_app_hot_urls", f"""
    WITH c AS (SELECT url, s + INTERVAL 1 HOUR AS window_end, count(*) AS cnt FROM (
        SELECT '/item/' || json_extract_string(props, '$.k') AS url, {sliding('1 HOUR', '10 MINUTE', '50 MINUTE')} AS s
        FROM events WHERE event_type <> 'click') GROUP BY 1, 2)
    SELECT window_end, url, cnt, row_num FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS row_num FROM c) WHERE row_num <= 5""")
def stream_app_hot_urls(spark, sf_dir):
    # Log lines; the watermark covers the disorder and the minutes a window may still change.
    log = event_stream(spark, sf_dir).select(
        F.concat_ws(
            " ", F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"),
            F.date_format("ts", analytics.LOG_TIME), F.lit("+0000"),
            F.when(F.col("event_type") == "click", "POST").otherwise("GET"),
            F.concat(F.lit("/item/"), F.get_json_object("props", "$.k")),
        ).alias("value")
    )
    requests = readers.decode_web_log(log, time_format=analytics.LOG_TIME).select(
        "url", F.col("time").cast("timestamp_ntz").alias("time")
    )
    timed = with_event_time(requests, "time", "25 minutes")
    counts = timed.groupBy("url", F.window("time", "1 hour", "10 minutes")["end"].alias("window_end")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    ranked = batches.rank_updates(counts, ["url"], "window_end", ["cnt", "url"], 5)
    return times(ranked, "window_end").select("window_end", "url", "cnt", "row_num")


@query("stream_app_ad_clicks", f"""
    WITH c AS (SELECT event_type, ts, row_number() OVER (
        PARTITION BY user_id, event_type, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY event_id) AS nth FROM events)
    SELECT event_type, s AS window_start, count(*) AS n FROM (
      SELECT *, {sliding('1 HOUR', '10 MINUTE', '50 MINUTE')} AS s FROM c WHERE nth < 2) GROUP BY 1, 2""")
def stream_app_ad_clicks(spark, sf_dir):
    # The event type stands for the advertisement and for the province: both lie on the click row.
    passed = clicks_of_day(spark, sf_dir, "ads").where("nth < 2").select("event_type", "ts")
    # The clicks that pass are a stream of their own, so that alerts and counts can both read them.
    base = scratch(spark, "clicks")
    passed.write.parquet(base)
    clicks = with_event_time(table_stream(spark, base, passed.schema), "ts", "1 hour")
    counted = windows.slide(clicks, ["event_type"], "ts", "1 hour", "10 minutes", n=F.count(F.lit(1)))
    newest = run_to_upsert(counted, ["event_type", "window_start", "window_end"], "ads")
    return times(newest, "window_start").select("event_type", "window_start", "n")


@query("stream_app_login_risk", f"""
    SELECT user_id, 'pair' AS detector, previous_time AS since, ts AS until FROM ({ORACLES['stream_login_fail_pairs']})
    UNION ALL SELECT user_id, 'pattern', first_time, ts FROM ({ORACLES['stream_pattern_consecutive']})
    UNION ALL SELECT user_id, 'burst', first_time, last_time FROM ({ORACLES['stream_login_fail_burst']})""")
def stream_app_login_risk(spark, sf_dir):
    def shown(rows, detector, since, until):
        return rows.select("user_id", F.lit(detector).alias("detector"), F.col(since).alias("since"), F.col(until).alias("until"))

    replay = replayed(spark, sf_dir, "event_type", beyond="6 hours")  # as far as the bursts need; the pattern waits for nothing
    return union_all(
        shown(stream_login_fail_pairs(spark, sf_dir), "pair", "previous_time", "ts"),
        shown(stream_pattern_consecutive(spark, sf_dir, replay), "pattern", "first_time", "ts"),
        shown(stream_login_fail_burst(spark, sf_dir, replay), "burst", "first_time", "last_time"),
    )


@query("stream_app_order_timeout", f"""
    SELECT user_id, kind, create_time, pay_time FROM ({ORACLES['stream_order_pay_monitor']})
    UNION ALL SELECT user_id, 'pattern_' || kind, begin_time, then_time FROM ({ORACLES['stream_pattern_followed_by']})""")
def stream_app_order_timeout(spark, sf_dir):
    replay = replayed(spark, sf_dir, "event_type", beyond="2 days")
    found = stream_pattern_followed_by(spark, sf_dir, replay).select(
        "user_id", F.concat(F.lit("pattern_"), "kind").alias("kind"),
        F.col("begin_time").alias("create_time"), F.col("then_time").alias("pay_time"),
    )
    return stream_order_pay_monitor(spark, sf_dir, replay).unionByName(found)


# -------------------------------------------------------------------------------- timers

def _until_all_fired(running, result, keys, patience=300):
    """Wait until each key has fired; raise if no further key does for a while."""
    seen, quiet = 0, 0
    while seen < keys:
        if running.awaitTermination(1):
            raise RuntimeError("the timer stream ended early")
        begun = any(p["batchId"] > 0 for p in running.recentProgress)  # the first batch has written its folder
        now = result().select("user_id").distinct().count() if begun else 0
        seen, quiet = now, 0 if now > seen else quiet + 1
        if quiet > patience:
            raise RuntimeError(f"{seen} of {keys} timers fired")


@query("periodic_timer", "SELECT DISTINCT user_id FROM events")
def periodic_timer(spark, sf_dir):
    # Each user's timer is armed by the rows and must have fired at least once.
    base = scratch(spark, "timer")
    fired = keyed.periodic_timer(event_stream(spark, sf_dir).select("user_id"), ["user_id"], 1000)
    users = events(spark, sf_dir).select("user_id").distinct().count()
    with state_settings(spark):
        running = (
            fired.writeStream.format("parquet").option("path", f"{base}/data")
            .option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="1 second").start()
        )
        try:
            _until_all_fired(running, lambda: spark.read.schema(fired.schema).parquet(f"{base}/data"), users)
        finally:
            running.stop()
    return spark.read.schema(fired.schema).parquet(f"{base}/data").select("user_id").distinct()

"""Queries of aggregation, OVER windows, detectors and sequence patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalar import bit_offset
from millrace.operators import aggregates as agg
from millrace.operators import alerts, over, patterns, topn
from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence
from millrace.plans.registry import events, query, table

def item():
    """The item of an event, from its JSON properties."""
    return F.get_json_object("props", "$.k").cast("bigint")


ITEM_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
RUNNING_SQL = "(PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"


def keyed_events(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "value", "ts")


# ------------------------------------------------------------------- final aggregates

@query("group_sum_batch", """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""")
def group_sum_batch(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word"), F.lit(1).alias("one"))
    return agg.group_agg(words, ["word"], n=F.sum("one"))


@query("table_group_agg", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1, 2""")
def table_group_agg(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total "
        "FROM {o} GROUP BY o_orderstatus, o_orderpriority", o=orders,
    )


CLICK_PLACE_SQL = """
    FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""


def user_provinces(spark, sf_dir):
    """The nation of each user; Spark broadcasts the nations if their measured size allows it."""
    buyers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province"))
    return buyers.join(nations, "c_nationkey").drop("c_nationkey")


def placed_clicks(spark, sf_dir):
    """Clicks with the clicked item and the nation of the user; AQE splits a skewed user."""
    clicks = events(spark, sf_dir).where("event_type = 'click'").withColumn("ad_id", item())
    return clicks.join(user_provinces(spark, sf_dir), "user_id").drop("props")


@query("composite_key_count", f"""
    SELECT n_name AS province, {ITEM_SQL} AS ad_id, count(*) AS n {CLICK_PLACE_SQL}
    WHERE event_type = 'click' GROUP BY 1, 2""")
def composite_key_count(spark, sf_dir):
    # Counted per user and item before the join, so a user with very many clicks joins as few rows.
    clicks = events(spark, sf_dir).where("event_type = 'click'").select("user_id", item().alias("ad_id"))
    per_user = agg.composite_key_count(clicks, ["user_id", "ad_id"], "c")
    placed = per_user.join(user_provinces(spark, sf_dir), "user_id")
    return placed.groupBy("province", "ad_id").agg(F.sum("c").alias("n"))


@query("concat_key_count", "SELECT lang || '_' || source AS key, count(*) AS n FROM documents GROUP BY 1")
def concat_key_count(spark, sf_dir):
    return agg.concat_key_count(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("pv_count", "SELECT count(*) AS pv FROM events WHERE event_type = 'view'")
def pv_count(spark, sf_dir):
    return agg.pv_count(events(spark, sf_dir), F.col("event_type") == "view")


@query("distinct_values", """
    SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value
    FROM events GROUP BY 1, 2""")
def distinct_values(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "value")
    return agg.distinct_values(rows, ["user_id", "event_type"], "event_id")


# ------------------------------------------------------------------ running aggregates

@query("running_sum", f"SELECT event_id, user_id, round(sum(value) OVER {RUNNING_SQL}, 4) AS total FROM events")
def running_sum(spark, sf_dir):
    rows = agg.running_sum(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", "total")
    return rows.select("event_id", "user_id", F.round("total", 4).alias("total"))


@query("running_max", f"""
    SELECT event_id, user_id, max(value) OVER {RUNNING_SQL} AS max_value, first(ts) OVER {RUNNING_SQL} AS first_ts
    FROM events""")
def running_max(spark, sf_dir):
    rows = agg.running_max(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", {"first_ts": "ts"})
    return rows.select("event_id", "user_id", "max_value", "first_ts")


@query("running_max_by", f"""
    SELECT event_id, user_id, best.value AS best_value, best.event_id AS best_id, best.ts AS best_ts FROM (
      SELECT event_id, user_id,
             max({{'value': value, 'event_id': event_id, 'ts': ts}}) OVER {RUNNING_SQL} AS best FROM events)""")
def running_max_by(spark, sf_dir):
    rows = agg.running_max_by(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", "event_id")
    best = F.col("best")
    return rows.select(
        "event_id", "user_id", best["value"].alias("best_value"), best["event_id"].alias("best_id"), best["ts"].alias("best_ts")
    )


@query("running_reduce", f"SELECT event_id, user_id, ts, max(value) OVER {RUNNING_SQL} AS highest FROM events")
def running_reduce(spark, sf_dir):
    rows = agg.running_reduce(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", "highest")
    return rows.select("event_id", "user_id", "ts", "highest")


@query("running_count", """
    SELECT event_id, row_number() OVER (ORDER BY event_id) AS nth FROM events WHERE event_type = 'view'""")
def running_count(spark, sf_dir):
    views = events(spark, sf_dir).where("event_type = 'view'").select("event_id")
    return agg.running_count(views, ["event_id"])


@query("running_distinct", """
    SELECT event_id, user_id, CAST(sum(CASE WHEN r = 1 THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS BIGINT) AS uv FROM (
      SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)""")
def running_distinct(spark, sf_dir):
    return agg.running_distinct(events(spark, sf_dir).select("event_id", "user_id"), "user_id", "event_id")


@query("running_reduce_sum", f"SELECT event_id, user_id, ts, round(sum(value) OVER {RUNNING_SQL}, 4) AS total FROM events")
def running_reduce_sum(spark, sf_dir):
    rows = agg.running_sum(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", "total")
    return rows.select("event_id", "user_id", "ts", F.round("total", 4).alias("total"))


@query("running_avg", f"SELECT event_id, user_id, round(avg(value) OVER {RUNNING_SQL}, 8) AS average FROM events")
def running_avg(spark, sf_dir):
    rows = agg.running_avg(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value", "average")
    return rows.select("event_id", "user_id", F.round("average", 8).alias("average"))


@query("keyed_profile", f"""
    SELECT event_id, user_id, value AS last_value, count(*) OVER {RUNNING_SQL} AS n,
           round(sum(value) OVER {RUNNING_SQL}, 4) AS total, max(value) OVER {RUNNING_SQL} AS highest,
           round(avg(value) OVER {RUNNING_SQL}, 8) AS average,
           lag(value, 2) OVER (PARTITION BY user_id ORDER BY event_id) AS third_last FROM events""")
def keyed_profile(spark, sf_dir):
    rows = agg.keyed_profile(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], "value")
    third = F.when(F.size("recent") == 3, F.get("recent", F.lit(0)))
    return rows.select(
        "event_id", "user_id", "last_value", "n", F.round("total", 4).alias("total"), "highest",
        F.round("average", 8).alias("average"), third.alias("third_last"),
    )


# -------------------------------------------------------------------- skew and distinct

HOUR_SQL = "time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')"


@query("salted_two_phase", f"SELECT {HOUR_SQL} AS window_start, count(*) AS n FROM events GROUP BY 1")
def salted_two_phase(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.window("ts", "1 hour")["start"].alias("window_start"))
    return agg.salted_two_phase(rows, ["window_start"])


UV_SQL = f"SELECT {HOUR_SQL} AS window_start, count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view' GROUP BY 1"


def hourly_views(spark, sf_dir):
    views = events(spark, sf_dir).where("event_type = 'view'")
    return views.select(F.window("ts", "1 hour")["start"].alias("window_start"), "user_id")


@query("uv_window", UV_SQL)
def uv_window(spark, sf_dir):
    return agg.exact_distinct(hourly_views(spark, sf_dir), ["window_start"], "user_id")


@query("uv_bitmap", UV_SQL)
def uv_bitmap(spark, sf_dir):
    return agg.bitmap_distinct(hourly_views(spark, sf_dir), ["window_start"], bit_offset("user_id"))


@query("full_window_apply", f"""
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           CAST(count(*) AS DOUBLE) AS size, max(value) - min(value) AS spread FROM events GROUP BY 1, 2""")
def full_window_apply(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", F.window("ts", "1 day")["start"].alias("window_start"), "value")

    def fold(groups):
        return {"size": groups.size(), "low": groups.min(), "high": groups.max()}

    fields = {"size": "sum", "low": "min", "high": "max"}
    result = F.struct(F.col("size"), (F.col("high") - F.col("low")).alias("spread"))
    applied = agg.user_aggregate(rows, ["user_id", "window_start"], "value", fields, fold, result, "r")
    return applied.select("user_id", "window_start", "r.*")


# ------------------------------------------------------------------------- OVER windows

@query("over_unbounded_global", "SELECT event_id, round(sum(value) OVER (ORDER BY event_id), 3) AS total FROM events")
def over_unbounded_global(spark, sf_dir):
    rows = over.over_unbounded_global(events(spark, sf_dir).select("event_id", "value"), ["event_id"], "value", "total")
    return rows.select("event_id", F.round("total", 3).alias("total"))


@query("over_unbounded_et", """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts)) AS n FROM events""")
def over_unbounded_et(spark, sf_dir):
    # Times cut to the day, so that there are peers.
    rows = events(spark, sf_dir).select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("rt"))
    return over.over_unbounded_peers(rows, ["user_id"], "rt", n=seq.tally()).select("event_id", "user_id", "n")


@query("over_rows_bounded", """
    SELECT event_id, user_id,
           round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS total
    FROM events""")
def over_rows_bounded(spark, sf_dir):
    rows = over.over_rows(keyed_events(spark, sf_dir), ["user_id"], ["event_id"], 2, total=F.sum("value"))
    return rows.select("event_id", "user_id", F.round("total", 4).alias("total"))


@query("over_named_sql", """
    SELECT event_id, user_id, round(sum(value) OVER w, 4) AS total, count(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def over_named_sql(spark, sf_dir):
    # The slices take the part of a plain key when one user is too large for a task.
    rows = sequence(keyed_events(spark, sf_dir), ["user_id"], ["event_id"])
    if rows.sliced:
        both = rows.bounded(
            2,
            total=lambda w: F.sum("value").over(w.rowsBetween(-2, 0)),
            n=lambda w: F.count(F.lit(1)).over(w.rowsBetween(-2, 0)),
        ).df
        return both.select("event_id", "user_id", F.round("total", 4).alias("total"), "n")
    return spark.sql(
        """SELECT event_id, user_id, round(sum(value) OVER w, 4) AS total, count(*) OVER w AS n FROM {e}
           WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        e=rows.df,
    )


@query("over_row_number", """
    SELECT day, item, cnt, row_num FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY day ORDER BY cnt DESC, item) AS INTEGER) AS row_num FROM (
        SELECT date_trunc('day', ts) AS day, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item, count(*) AS cnt
        FROM events GROUP BY 1, 2)) WHERE row_num <= 10""")
def over_row_number(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    counts = events(spark, sf_dir).groupBy(day, item().alias("item")).agg(F.count(F.lit(1)).alias("cnt"))
    return over.row_number_by(counts, ["day"], [F.col("cnt").desc(), F.col("item").asc()]).where("row_num <= 10")


@query("prev_value_jump", """
    SELECT event_id, user_id, value, previous_value FROM (
      SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_value FROM events)
    WHERE abs(value - previous_value) > 10""")
def prev_value_jump(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    return over.prev_value_jump(rows, ["user_id"], ["event_id"], "value", 10)


@query("running_top3", """
    SELECT e.event_id, e.user_id, max(CASE WHEN r = 1 THEN value END) AS top1, max(CASE WHEN r = 2 THEN value END) AS top2,
           max(CASE WHEN r = 3 THEN value END) AS top3, coalesce(max(CASE WHEN r = 3 THEN id END), -1) AS top3_event_id
    FROM (SELECT a.event_id, a.user_id, b.value, b.event_id AS id,
                 row_number() OVER (PARTITION BY a.event_id ORDER BY b.value DESC, b.event_id) AS r
          FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_id <= a.event_id) e
    WHERE r <= 3 GROUP BY 1, 2""")
def running_top3(spark, sf_dir):
    rows = topn.running_top(events(spark, sf_dir).select("event_id", "user_id", "value"), ["user_id"], ["event_id"], "value")
    third = F.coalesce("top3_event_id", F.lit(-1))
    return rows.select("event_id", "user_id", "top1", "top2", "top3", third.alias("top3_event_id"))


# ------------------------------------------------------------------------------- alerts

def no_drop_sql(source: str, horizon: str) -> str:
    return f"""
    WITH d AS (SELECT *, coalesce(value < lag(value) OVER w, false) AS dropped FROM {source}
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(CASE WHEN dropped THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stretch FROM d),
    g AS (SELECT user_id, stretch, min(ts) FILTER (NOT dropped) AS since, min(ts) AS opened FROM s GROUP BY 1, 2),
    c AS (SELECT *, lead(opened) OVER (PARTITION BY user_id ORDER BY stretch) AS closing,
                 ({horizon}) AS horizon FROM g)
    SELECT user_id, since, nth, since + nth * INTERVAL 12 HOUR AS alert_time
    FROM (SELECT *, unnest(generate_series(1, 100)) AS nth FROM c WHERE since IS NOT NULL)
    WHERE CASE WHEN closing IS NULL THEN since + nth * INTERVAL 12 HOUR <= horizon
               ELSE since + nth * INTERVAL 12 HOUR < closing END"""


@query("no_drop_alert", no_drop_sql("events", "SELECT max(ts) FROM events"))
def no_drop_alert(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    return alerts.no_drop_alert(rows, ["user_id"], "ts", "event_id", "value", "12 hours")


BLACKLIST_CTE = """
    WITH c AS (SELECT user_id, event_type, event_id, ts, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day,
      row_number() OVER (PARTITION BY user_id, event_type, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY event_id) AS nth
      FROM events)"""


def blacklisted(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    both = alerts.blacklist_filter(rows, ["user_id", "event_type"], "ts", ["event_id"], 2, "8 hours")
    return [d.withColumn("local_day", F.col("local_day").cast("string")) for d in both]


@query("blacklist_filter", BLACKLIST_CTE + "SELECT user_id, event_type, event_id, ts, local_day, nth FROM c WHERE nth < 2")
def blacklist_filter(spark, sf_dir):
    return blacklisted(spark, sf_dir)[0]


@query("blacklist_alerts", BLACKLIST_CTE + "SELECT user_id, event_type, local_day, ts, event_id FROM c WHERE nth = 2")
def blacklist_alerts(spark, sf_dir):
    return blacklisted(spark, sf_dir)[1]


FAIL_PAIRS_SQL = """
    SELECT user_id, event_id, ts, previous_time FROM (
      SELECT *, lag(event_type) OVER w AS before, lag(ts) OVER w AS previous_time FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    WHERE event_type = 'error' AND before = 'error' AND abs(epoch_us(ts) - epoch_us(previous_time)) <= 21600000000"""


@query("login_fail_pairs", FAIL_PAIRS_SQL)
def login_fail_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    pairs = alerts.login_fail_pairs(rows, ["user_id"], "ts", ["event_id"], F.col("event_type") == "error", "6 hours")
    return pairs.drop("event_type")


def burst_sql(hours: int, source: str = "events") -> str:
    return f"""
    WITH RECURSIVE f AS (SELECT user_id, ts, event_id, event_type,
        sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
      FROM {source}),
    e AS (SELECT user_id, run, ts FROM f WHERE event_type = 'error'),
    ok AS (SELECT user_id, run, ts FROM f WHERE event_type <> 'error'),
    b AS (SELECT user_id, run, min(ts) AS first_time FROM e GROUP BY 1, 2
      UNION ALL
      SELECT user_id, run, first_time FROM (
        SELECT b.user_id, b.run, min(e.ts) AS first_time
        FROM b JOIN e ON e.user_id = b.user_id AND e.run = b.run AND e.ts > b.first_time + INTERVAL {hours} HOUR
        GROUP BY b.user_id, b.run, b.first_time))
    SELECT b.user_id, b.first_time, max(e.ts) AS last_time, count(*) AS n
    FROM b JOIN e ON e.user_id = b.user_id AND e.run = b.run AND e.ts BETWEEN b.first_time AND b.first_time + INTERVAL {hours} HOUR
    LEFT JOIN ok ON ok.user_id = b.user_id AND ok.run = b.run + 1
    WHERE ok.ts IS NULL OR ok.ts > b.first_time + INTERVAL {hours} HOUR
    GROUP BY b.user_id, b.first_time HAVING count(*) >= 2"""


@query("login_fail_burst", burst_sql(6))
def login_fail_burst(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return alerts.login_fail_burst(rows, ["user_id"], "ts", "event_id", F.col("event_type") == "error", "6 hours")


def monitor_sql(source: str, open_end: str) -> str:
    """``open_end`` tells when a create that nothing follows counts as unpaid."""
    return f"""
    WITH r AS (SELECT user_id, ts, event_type, lag(event_type) OVER w AS before, lag(ts) OVER w AS before_ts, lead(ts) OVER w AS next_ts
      FROM {source} WHERE event_type IN ('signup', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    k AS (SELECT *, coalesce(before = 'signup' AND ts <= before_ts + INTERVAL 2 DAY, false) AS live FROM r)
    SELECT user_id, 'paid' AS kind, before_ts AS create_time, ts AS pay_time FROM k WHERE event_type = 'purchase' AND live
    UNION ALL SELECT user_id, 'pay_without_create', NULL, ts FROM k WHERE event_type = 'purchase' AND NOT live
    UNION ALL SELECT user_id, 'no_pay', ts, NULL FROM k WHERE event_type = 'signup'
      AND (next_ts > ts + INTERVAL 2 DAY OR (next_ts IS NULL AND {open_end}))"""


MONITOR_SQL = monitor_sql("events", "true")


@query("order_pay_monitor", MONITOR_SQL)
def order_pay_monitor(spark, sf_dir):
    return alerts.order_pay_monitor(
        events(spark, sf_dir), "user_id", "ts", "event_id",
        F.col("event_type") == "signup", F.col("event_type") == "purchase", "2 days",
    )


# ----------------------------------------------------------------------------- patterns

CONSECUTIVE_SQL = """
    SELECT user_id, event_id, ts, first_time, first_event_id FROM (
      SELECT *, lag(ts) OVER w AS first_time, lag(event_id) OVER w AS first_event_id, lag(event_type) OVER w AS before
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND before = 'error' AND ts < first_time + INTERVAL 12 HOUR"""


@query("pattern_consecutive", CONSECUTIVE_SQL)
def pattern_consecutive(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    found = patterns.pattern_consecutive(
        rows, ["user_id"], "ts", "event_id", F.col("event_type") == "error", 2, "12 hours"
    )
    return found.drop("event_type")


@query("pattern_consecutive_3", """
    SELECT user_id, event_id, ts, first_time, first_event_id FROM (
      SELECT *, lag(ts, 2) OVER w AS first_time, lag(event_id, 2) OVER w AS first_event_id,
             lag(event_type, 2) OVER w AS a, lag(event_type) OVER w AS b
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND a = 'error' AND b = 'error' AND ts < first_time + INTERVAL 3 DAY""")
def pattern_consecutive_3(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    found = patterns.pattern_consecutive(
        rows, ["user_id"], "ts", "event_id", F.col("event_type") == "error", 3, "3 days"
    )
    return found.drop("event_type")


FOLLOWED_CTE = """
    WITH n AS (SELECT user_id, event_id, ts, event_type,
        min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER w AS next_id,
        min(CASE WHEN event_type = 'purchase' THEN ts END) OVER w AS next_ts
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    m AS (SELECT *, coalesce(next_ts < ts + INTERVAL 2 DAY, false) AS hit FROM n WHERE event_type = 'signup')"""
FOLLOWED_SQL = FOLLOWED_CTE + """
    SELECT user_id, event_id AS begin_event_id, ts AS begin_time, CASE WHEN hit THEN next_id ELSE -1 END AS then_event_id,
           CASE WHEN hit THEN next_ts END AS then_time, CASE WHEN hit THEN 'matched' ELSE 'timeout' END AS kind,
           CASE WHEN NOT hit THEN ts + INTERVAL 2 DAY END AS timeout_time FROM m"""


@query("pattern_followed_by", FOLLOWED_SQL)
def pattern_followed_by(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    found = patterns.pattern_followed_by(
        rows, ["user_id"], "ts", "event_id",
        F.col("event_type") == "signup", F.col("event_type") == "purchase", "2 days",
    )
    return found.withColumn("then_event_id", F.coalesce("then_event_id", F.lit(-1)))


@query("pattern_timeout", FOLLOWED_CTE + """
    SELECT user_id, event_id AS begin_event_id, ts AS begin_time, ts + INTERVAL 2 DAY AS timeout_time FROM m WHERE NOT hit""")
def pattern_timeout(spark, sf_dir):
    return patterns.pattern_timeout(pattern_followed_by(spark, sf_dir)).drop("then_event_id")

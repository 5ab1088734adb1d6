"""Queries of windows, watermarks, rankings, joins and the worked analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.udfs import average
from millrace.operators import joins, topn, watermark, windows
from millrace.operators import sequence as seq
from millrace.plans import analytics
from millrace.plans.keyed import (
    CLICK_PLACE_SQL, CONSECUTIVE_SQL, FAIL_PAIRS_SQL, FOLLOWED_SQL, HOUR_SQL, ITEM_SQL,
    MONITOR_SQL, UV_SQL, burst_sql, item, placed_clicks,
)
from millrace.plans.registry import SHIFTED_SQL, events, query, shifted_events, table
from millrace.plans.rows import TOKENS_SQL


def bucket(width: str, column: str = "ts") -> str:
    return f"time_bucket(INTERVAL {width}, {column}, TIMESTAMP '1970-01-01')"


SHIFTED_CTE = f"WITH e AS (SELECT *, {SHIFTED_SQL} AS et FROM events)"


def sliding(size: str, step: str, back: str, column: str = "ts") -> str:
    """Starts of the sliding windows that hold a row."""
    return (f"unnest(generate_series({bucket(step, column)} - INTERVAL {back}, {bucket(step, column)}, INTERVAL {step}))")


# ----------------------------------------------------------------------- time windows

@query("tumble_all", f"""
    SELECT {bucket('6 HOUR')} AS window_start, {bucket('6 HOUR')} + INTERVAL 6 HOUR AS window_end,
           count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def tumble_all(spark, sf_dir):
    return windows.tumble(
        events(spark, sf_dir), [], "ts", "6 hours", n=F.count(F.lit(1)), total=F.round(F.sum("value"), 4)
    )


@query("tumble_pt", f"""
    SELECT user_id, {bucket('1 DAY')} AS window_start, count(*) AS n, max(value) AS highest FROM events GROUP BY 1, 2""")
def tumble_pt(spark, sf_dir):
    # The arrival time stands for processing time, so a rerun gives the same rows.
    rows = windows.tumble(
        events(spark, sf_dir), ["user_id"], "ts", "1 day", n=F.count(F.lit(1)), highest=F.max("value")
    )
    return rows.drop("window_end")


TUMBLE_ET_SQL = SHIFTED_CTE + f"""
    SELECT user_id, {bucket('1 DAY', 'et')} AS window_start, {bucket('1 DAY', 'et')} + INTERVAL 1 DAY AS window_end,
           round(sum(value), 4) AS total FROM e GROUP BY 1, 2, 3"""


@query("tumble_et", TUMBLE_ET_SQL)
def tumble_et(spark, sf_dir):
    return windows.tumble(
        shifted_events(spark, sf_dir), ["user_id"], "et", "1 day", total=F.round(F.sum("value"), 4)
    )


@query("incremental_window_agg", SHIFTED_CTE + f"""
    SELECT user_id, {bucket('1 DAY', 'et')} AS window_start, {bucket('1 DAY', 'et')} + INTERVAL 1 DAY AS window_end,
           count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 8) AS average FROM e GROUP BY 1, 2, 3""")
def incremental_window_agg(spark, sf_dir):
    # Accumulators are merged before and after the shuffle; rows are never kept per window.
    return windows.tumble(
        shifted_events(spark, sf_dir), ["user_id"], "et", "1 day", n=F.count(F.lit(1)),
        total=F.round(F.sum("value"), 4), average=F.round(average("value"), 8),
    )


@query("slide_pt", f"""
    SELECT user_id, s AS window_start, s + INTERVAL 5 HOUR AS window_end, round(sum(value), 4) AS total FROM (
      SELECT *, {sliding('5 HOUR', '2 HOUR', '4 HOUR')} AS s FROM events)
    WHERE ts < s + INTERVAL 5 HOUR GROUP BY 1, 2, 3""")
def slide_pt(spark, sf_dir):
    rows = windows.slide(events(spark, sf_dir), ["user_id"], "ts", "5 hours", "2 hours", total=F.sum("value"))
    return rows.withColumn("total", F.round("total", 4))


@query("slide_et", SHIFTED_CTE + f"""
    SELECT user_id, s AS window_start, s + INTERVAL 6 HOUR AS window_end, round(sum(value), 4) AS total, count(*) AS n,
           max(value) AS highest FROM (SELECT *, {sliding('6 HOUR', '2 HOUR', '4 HOUR', 'et')} AS s FROM e) GROUP BY 1, 2, 3""")
def slide_et(spark, sf_dir):
    rows = windows.slide_panes(
        shifted_events(spark, sf_dir), ["user_id"], "et", "6 hours", "2 hours",
        total=("sum", "value"), n=("count", "*"), highest=("max", "value"),
    )
    return rows.withColumn("total", F.round("total", 4))


def session_sql(column: str, source: str, hours: int) -> str:
    return f"""
    SELECT user_id, min({column}) AS window_start, max({column}) + INTERVAL {hours} HOUR AS window_end,
           count(*) AS n, round(sum(value), 4) AS total FROM (
      SELECT *, sum(CASE WHEN before IS NULL OR {column} > before + INTERVAL {hours} HOUR THEN 1 ELSE 0 END)
               OVER (PARTITION BY user_id ORDER BY {column}, event_id) AS s FROM (
        SELECT *, lag({column}) OVER (PARTITION BY user_id ORDER BY {column}, event_id) AS before FROM {source}))
    GROUP BY user_id, s"""


@query("session_pt", session_sql("ts", "events", 12))
def session_pt(spark, sf_dir):
    rows = windows.session_hot(
        events(spark, sf_dir), ["user_id"], "ts", "event_id", "12 hours",
        n=F.count(F.lit(1)), total=F.sum("value"),
    )
    return rows.withColumn("total", F.round("total", 4))


@query("session_et", SHIFTED_CTE + session_sql("et", "e", 8))
def session_et(spark, sf_dir):
    rows = windows.session_hot(
        shifted_events(spark, sf_dir), ["user_id"], "et", "event_id", "8 hours",
        n=F.count(F.lit(1)), total=F.sum("value"),
    )
    return rows.withColumn("total", F.round("total", 4))


@query("window_bounds", SHIFTED_CTE + f"""
    SELECT event_type, s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS n FROM (
      SELECT *, {sliding('1 DAY', '6 HOUR', '18 HOUR', 'et')} AS s FROM e) GROUP BY 1, 2, 3""")
def window_bounds(spark, sf_dir):
    return windows.slide_panes(shifted_events(spark, sf_dir), ["event_type"], "et", "1 day", "6 hours", n=("count", "*"))


# ---------------------------------------------------------------------- count windows

NUMBERED_SQL = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events"


@query("count_tumble", f"""
    SELECT user_id, CAST((nth - 1) // 5 AS BIGINT) AS window_no, round(sum(value), 4) AS total FROM ({NUMBERED_SQL})
    GROUP BY 1, 2 HAVING count(*) = 5""")
def count_tumble(spark, sf_dir):
    return windows.count_tumble(
        events(spark, sf_dir).select("user_id", "event_id", "value"), ["user_id"], ["event_id"], 5,
        total=F.round(F.sum("value"), 4),
    )


def count_slide_sql(condition: str) -> str:
    return f"""
    SELECT user_id, event_id, nth, total FROM (
      SELECT user_id, event_id, nth, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS total FROM ({NUMBERED_SQL})) WHERE {condition}"""


def _count_slide(spark, sf_dir, first_full):
    rows = windows.count_slide(
        events(spark, sf_dir).select("user_id", "event_id", "value"), ["user_id"], ["event_id"], 5, 2,
        first_full=first_full, total=lambda w: F.round(F.sum("value").over(w), 4),
    )
    return rows.select("user_id", "event_id", "nth", "total")


@query("count_slide", count_slide_sql("nth % 2 = 0"))
def count_slide(spark, sf_dir):
    return _count_slide(spark, sf_dir, False)


@query("count_slide_table", count_slide_sql("nth >= 5 AND (nth - 5) % 2 = 0"))
def count_slide_table(spark, sf_dir):
    return _count_slide(spark, sf_dir, True)


@query("eager_trigger", f"""
    SELECT event_id, user_id, {bucket('1 DAY')} AS window_start,
           count(*) OVER (PARTITION BY user_id, {bucket('1 DAY')} ORDER BY event_id) AS n FROM events""")
def eager_trigger(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts")
    return windows.eager_window(rows, ["user_id"], "ts", "event_id", "1 day", n=seq.tally()).drop("ts")


# -------------------------------------------------------------- watermarks, late rows

def watermark_sql(minutes: int, frame: str) -> str:
    return (f"max(et) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND {frame}) - INTERVAL {minutes} MINUTE")


@query("watermark_replay", SHIFTED_CTE + f"SELECT event_id, et, {watermark_sql(30, '1 PRECEDING')} AS watermark FROM e")
def watermark_replay(spark, sf_dir):
    rows = shifted_events(spark, sf_dir).select("event_id", "et")
    return watermark.watermark_replay(rows, "et", "event_id", "30 minutes")


@query("wm_punctuated", SHIFTED_CTE + f"SELECT event_id, et, {watermark_sql(2, 'CURRENT ROW')} AS watermark FROM e")
def wm_punctuated(spark, sf_dir):
    rows = shifted_events(spark, sf_dir).select("event_id", "et")
    return watermark.wm_punctuated(rows, "et", "event_id", "2 minutes")


LATE_CTE = SHIFTED_CTE + f""",
    w AS (SELECT *, {watermark_sql(10, '1 PRECEDING')} AS wm FROM e),
    p AS (SELECT *, {bucket('1 HOUR', 'et')} AS window_start, {bucket('1 HOUR', 'et')} + INTERVAL 1 HOUR AS window_end FROM w)"""


@query("allowed_lateness", LATE_CTE + """,
    first AS (SELECT event_type, window_start, window_end, sum(value) AS total, count(*) AS n FROM p
              WHERE wm IS NULL OR window_end > wm GROUP BY 1, 2, 3),
    late AS (SELECT *, row_number() OVER w AS firing, sum(value) OVER w AS late_total FROM p
             WHERE window_end <= wm AND window_end + INTERVAL 20 MINUTE > wm
             WINDOW w AS (PARTITION BY event_type, window_start ORDER BY event_id))
    SELECT event_type, window_start, window_end, CAST(0 AS BIGINT) AS firing, round(total, 4) AS total, n FROM first
    UNION ALL
    SELECT l.event_type, l.window_start, l.window_end, firing, round(coalesce(f.total, 0) + late_total, 4),
           coalesce(f.n, 0) + firing
    FROM late l LEFT JOIN first f USING (event_type, window_start)""")
def allowed_lateness(spark, sf_dir):
    rows = shifted_events(spark, sf_dir).select("event_id", "event_type", "et", "value")
    fired = watermark.allowed_lateness(
        rows, ["event_type"], "et", "event_id", "1 hour", "10 minutes", "20 minutes", "value"
    )
    return fired.withColumn("total", F.round("total", 4))


@query("late_side_output", LATE_CTE + """
    SELECT event_id, et, wm AS watermark FROM p WHERE window_end + INTERVAL 5 MINUTE <= wm""")
def late_side_output(spark, sf_dir):
    rows = shifted_events(spark, sf_dir).select("event_id", "et")
    return watermark.late_side_output(rows, "et", "event_id", "1 hour", "10 minutes", lateness="5 minutes")[1]


@query("late_side_output_sliding", LATE_CTE + f"""
    SELECT event_id, et, wm AS watermark FROM p WHERE {bucket('10 MINUTE', 'et')} + INTERVAL 30 MINUTE <= wm""")
def late_side_output_sliding(spark, sf_dir):
    rows = shifted_events(spark, sf_dir).select("event_id", "et")
    return watermark.late_side_output(rows, "et", "event_id", "30 minutes", "10 minutes", step="10 minutes")[1]


# --------------------------------------------------------------------------- rankings

HOT_ITEMS_SQL = f"""
    WITH c AS (SELECT item, s + INTERVAL 1 HOUR AS window_end, count(*) AS cnt FROM (
        SELECT {ITEM_SQL} AS item, {sliding('1 HOUR', '5 MINUTE', '55 MINUTE')} AS s FROM events WHERE event_type = 'view')
      GROUP BY 1, 2)
    SELECT window_end, item, cnt, row_num FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item) AS INTEGER) AS row_num FROM c) WHERE row_num <= 5"""


@query("hot_items_sql", HOT_ITEMS_SQL)
def hot_items_sql(spark, sf_dir):
    views = events(spark, sf_dir).where("event_type = 'view'").select("ts", item().alias("item"))
    return spark.sql(
        """SELECT window_end, item, cnt, row_num FROM (
             SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item) AS row_num FROM (
               SELECT item, window(ts, '1 hour', '5 minutes').end AS window_end, count(*) AS cnt
               FROM {views} GROUP BY item, window(ts, '1 hour', '5 minutes')))
           WHERE row_num <= 5""",
        views=views,
    )


@query("hot_items_state", HOT_ITEMS_SQL)
def hot_items_state(spark, sf_dir):
    views = events(spark, sf_dir).where("event_type = 'view'").select("ts", item().alias("item"))
    return topn.hot_items(views, "item", "ts", "1 hour", "5 minutes", 5).select("window_end", "item", "cnt", "row_num")


HOT_URLS_SQL = SHIFTED_CTE + f""",
    w AS (SELECT event_id, event_type, et, {watermark_sql(10, '1 PRECEDING')} AS wm,
          '/item/' || json_extract_string(props, '$.k') AS url FROM e WHERE event_type <> 'click'),
    c AS (SELECT url, s + INTERVAL 1 HOUR AS window_end, count(*) AS cnt FROM (
        SELECT *, {sliding('1 HOUR', '10 MINUTE', '50 MINUTE', 'et')} AS s FROM w)
      WHERE wm IS NULL OR s + INTERVAL 1 HOUR + INTERVAL 15 MINUTE > wm GROUP BY 1, 2)
    SELECT window_end, url, cnt, row_num FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS row_num FROM c) WHERE row_num <= 5"""


def got_urls(spark, sf_dir):
    """GET requests of the events with out-of-order times."""
    url = F.concat(F.lit("/item/"), F.get_json_object("props", "$.k"))
    return shifted_events(spark, sf_dir).where("event_type <> 'click'").select("event_id", "et", url.alias("url"))


@query("hot_urls", HOT_URLS_SQL)
def hot_urls(spark, sf_dir):
    counts = watermark.late_sliding_counts(
        got_urls(spark, sf_dir), "url", "et", "event_id", "1 hour", "10 minutes", "10 minutes", "15 minutes"
    )
    ranked = topn.top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col("url").asc()], 5)
    return ranked.select("window_end", "url", "cnt", "row_num")


# ------------------------------------------------------------------------------ joins

FIRST_LINE_SQL = "SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1"


@query("match_join", f"""
    SELECT o_orderkey AS order_key, o_orderdate, shipped,
           CASE WHEN o_orderdate > shipped THEN 'left' ELSE 'right' END AS completed_by
    FROM orders JOIN ({FIRST_LINE_SQL}) ON o_orderkey = l_orderkey""")
def match_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate")
    first_lines = (
        table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.min("l_shipdate").alias("shipped"))
    )
    return joins.match_join(orders, first_lines, "order_key", "o_orderdate", "shipped")


PAYS = "orders JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 10 DAY"


def pays_and_receipts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_shipdate")
    return orders, lines


@query("interval_join", f"SELECT o_orderkey AS order_key, o_orderdate, l_linenumber, l_shipdate FROM {PAYS}")
def interval_join(spark, sf_dir):
    orders, lines = pays_and_receipts(spark, sf_dir)
    return joins.interval_join(orders, lines, "order_key", "o_orderdate", "l_shipdate", "-5 days", "10 days")


RECONCILE_SQL = """
    SELECT coalesce(o_orderkey, l_orderkey) AS order_key, o_orderdate, coalesce(l_linenumber, -1) AS l_linenumber, l_shipdate,
           CASE WHEN o_orderkey IS NULL THEN 'receipt_no_pay' WHEN l_orderkey IS NULL THEN 'pay_no_receipt'
                ELSE 'matched' END AS kind
    FROM orders FULL OUTER JOIN lineitem ON o_orderkey = l_orderkey
      AND l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 10 DAY"""


@query("reconcile_outer", RECONCILE_SQL)
def reconcile_outer(spark, sf_dir):
    orders, lines = pays_and_receipts(spark, sf_dir)
    both = joins.reconcile_outer(
        orders, lines, "order_key", "o_orderdate", "l_shipdate", "-5 days", "10 days",
        kinds=("matched", "pay_no_receipt", "receipt_no_pay"),
    )
    return both.withColumn("l_linenumber", F.coalesce("l_linenumber", F.lit(-1)))


@query("left_join_streams", """
    SELECT c_custkey, c_name, o_orderkey AS r_o_orderkey, o_custkey AS r_o_custkey, o_totalprice AS r_o_totalprice
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def left_join_streams(spark, sf_dir):
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.left_join(buyers, orders, "c_custkey", "o_custkey")


@query("control_broadcast", """
    SELECT event_id, CASE s WHEN '1' THEN 'switched to 1' WHEN '2' THEN 'switched to 2' ELSE 'switched to other' END AS label
    FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN CAST(user_id % 4 AS VARCHAR) END IGNORE NULLS)
                 OVER (ORDER BY event_id) AS s FROM events)
    WHERE event_type <> 'signup'""")
def control_broadcast(spark, sf_dir):
    rows = events(spark, sf_dir)
    control = rows.where("event_type = 'signup'").select("event_id", (F.col("user_id") % 4).cast("string").alias("switch"))
    data = rows.where("event_type <> 'signup'").select("event_id")
    switched = joins.control_broadcast(data, control, "event_id", "switch")
    value = F.col("switch_value")
    label = F.when(value == "1", "switched to 1").when(value == "2", "switched to 2").otherwise("switched to other")
    return switched.select("event_id", label.alias("label"))


# ------------------------------------------------------------------- worked analytics

@query("app_word_count", TOKENS_SQL)
def app_word_count(spark, sf_dir):
    return analytics.word_count(table(spark, sf_dir, "documents"), "text")


HOURLY_PV_SQL = f"SELECT {HOUR_SQL} AS window_start, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1"


@query("app_hourly_pv", HOURLY_PV_SQL)
def app_hourly_pv(spark, sf_dir):
    return analytics.hourly_pv(events(spark, sf_dir), F.col("event_type") == "view", "ts")


@query("app_hourly_pv_salted", HOURLY_PV_SQL)
def app_hourly_pv_salted(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "ts")
    return analytics.hourly_pv(rows, F.col("event_type") == "view", "ts", salts=8)


@query("app_hourly_uv", UV_SQL)
def app_hourly_uv(spark, sf_dir):
    return analytics.hourly_uv(events(spark, sf_dir), F.col("event_type") == "view", "ts", "user_id")


@query("app_hourly_uv_bitmap", UV_SQL)
def app_hourly_uv_bitmap(spark, sf_dir):
    return analytics.hourly_uv(events(spark, sf_dir), F.col("event_type") == "view", "ts", "user_id", bitmap=True)


@query("app_hot_items", HOT_ITEMS_SQL)
def app_hot_items(spark, sf_dir):
    return hot_items_state(spark, sf_dir)


@query("app_hot_urls", HOT_URLS_SQL)
def app_hot_urls(spark, sf_dir):
    # From log lines, as an access log arrives; times carry microseconds in an extra field.
    log = shifted_events(spark, sf_dir).select(
        "event_id",
        F.concat_ws(
            " ", F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"),
            F.date_format("et", analytics.LOG_TIME), F.lit("+0000"),
            F.when(F.col("event_type") == "click", "POST").otherwise("GET"),
            F.concat(F.lit("/item/"), F.get_json_object("props", "$.k")),
        ).alias("value"),
    )
    ranked = analytics.hot_urls(log, "event_id", "1 hour", "10 minutes", "10 minutes", "15 minutes", 5)
    return ranked.select("window_end", "url", "cnt", "row_num")


AD_SQL = f"""
    WITH k AS (SELECT e.event_id, e.ts, e.user_id, {ITEM_SQL} AS ad_id, n_name AS province {CLICK_PLACE_SQL}
               WHERE event_type = 'click'),
    c AS (SELECT *, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day, row_number() OVER (
            PARTITION BY user_id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY event_id) AS nth FROM k)"""


@query("app_ad_clicks", AD_SQL + f"""
    SELECT province, s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM (
      SELECT *, {sliding('1 HOUR', '1 MINUTE', '59 MINUTE')} AS s FROM c WHERE nth < 2) GROUP BY 1, 2, 3""")
def app_ad_clicks(spark, sf_dir):
    clicks = placed_clicks(spark, sf_dir).select("event_id", "ts", "user_id", "ad_id", "province")
    return analytics.ad_clicks(
        clicks, ["user_id"], "ts", "event_id", "province", threshold=2, size="1 hour", step="1 minute"
    )[0]


@query("app_ad_alerts", AD_SQL + "SELECT user_id, local_day, ts, event_id FROM c WHERE nth = 2")
def app_ad_alerts(spark, sf_dir):
    clicks = placed_clicks(spark, sf_dir).select("event_id", "ts", "user_id", "ad_id", "province")
    warned = analytics.ad_clicks(
        clicks, ["user_id"], "ts", "event_id", "province", threshold=2, size="1 hour", step="1 minute"
    )[1]
    return warned.withColumn("local_day", F.col("local_day").cast("string"))


@query("app_login_risk", f"""
    SELECT user_id, 'pair' AS detector, previous_time AS since, ts AS until FROM ({FAIL_PAIRS_SQL})
    UNION ALL SELECT user_id, 'pattern', first_time, ts FROM ({CONSECUTIVE_SQL})
    UNION ALL SELECT user_id, 'burst', first_time, last_time FROM ({burst_sql(24)})""")
def app_login_risk(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return analytics.login_risk(
        rows, "user_id", "ts", "event_id", F.col("event_type") == "error",
        pair_within="6 hours", pattern_within="12 hours", burst_within="24 hours",
    )


@query("app_order_timeout", f"""
    SELECT user_id, kind, create_time, pay_time FROM ({MONITOR_SQL})
    UNION ALL SELECT user_id, 'pattern_' || kind, begin_time, then_time FROM ({FOLLOWED_SQL})""")
def app_order_timeout(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return analytics.order_timeout(
        rows, "user_id", "ts", "event_id",
        F.col("event_type") == "signup", F.col("event_type") == "purchase", "2 days",
    )


@query("app_reconcile", f"""
    SELECT 'interval' AS method, 'matched' AS kind, count(*) AS n FROM {PAYS}
    UNION ALL SELECT 'outer', kind, count(*) FROM ({RECONCILE_SQL}) GROUP BY kind
    UNION ALL SELECT 'key', 'matched', count(*) FROM orders JOIN ({FIRST_LINE_SQL}) ON o_orderkey = l_orderkey""")
def app_reconcile(spark, sf_dir):
    orders, lines = pays_and_receipts(spark, sf_dir)
    return analytics.reconcile_report(
        orders, lines, "order_key", "o_orderdate", "l_shipdate", "-5 days", "10 days",
        kinds=("matched", "pay_no_receipt", "receipt_no_pay"),
    )


@query("app_channel_stats", "SELECT source || '_' || lang AS key, count(*) AS n FROM documents GROUP BY 1")
def app_channel_stats(spark, sf_dir):
    return analytics.channel_stats(table(spark, sf_dir, "documents"), "source", "lang")

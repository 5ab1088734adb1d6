"""Worked analytics: compositions of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import bit_offset
from millrace.operators import aggregates, alerts, joins, patterns, topn, watermark, windows
from millrace.operators.project import flatmap_tokens, union_all
from millrace.sources.readers import decode_web_log

# Access-log time with microseconds, for logs that carry them.
LOG_TIME = "dd/MM/yyyy:HH:mm:ss.SSSSSS"


def word_count(lines: DataFrame, column: str) -> DataFrame:
    return flatmap_tokens(lines, column).groupBy("word").agg(F.sum("n").alias("n"))


def hourly_pv(df: DataFrame, is_view: Column, time: str, salts: int | None = None) -> DataFrame:
    """Views per hour, directly or in two salted steps."""
    views = df.where(is_view).withColumn("window_start", F.window(time, "1 hour")["start"])
    if salts:
        return aggregates.salted_two_phase(views, ["window_start"], salts)
    return views.groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))


def hourly_uv(df: DataFrame, is_view: Column, time: str, user: str, bitmap: bool = False) -> DataFrame:
    """Different users per hour, exactly or by bitmap."""
    views = df.where(is_view).select(F.window(time, "1 hour")["start"].alias("window_start"), user)
    if bitmap:
        return aggregates.bitmap_distinct(views, ["window_start"], bit_offset(user))
    return aggregates.exact_distinct(views, ["window_start"], user)


def hot_items(df: DataFrame, is_view: Column, item: str, time: str, n: int = 5) -> DataFrame:
    """Top items of the last hour, every five minutes."""
    return topn.hot_items(df.where(is_view), item, time, "1 hour", "5 minutes", n)


def hot_urls(
    log: DataFrame, arrival: str, size: str, step: str, delay: str, lateness: str, n: int, column: str = "value"
) -> DataFrame:
    """Top GET urls per sliding window from access-log lines, late rows included while allowed."""
    parsed = decode_web_log(log, column, time_format=LOG_TIME, keep=[arrival])
    rows = parsed.select(arrival, "url", F.col("time").cast("timestamp_ntz").alias("time"))
    counts = watermark.late_sliding_counts(rows, "url", "time", arrival, size, step, delay, lateness)
    return topn.top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col("url").asc()], n)


def ad_clicks(
    clicks: DataFrame,
    key: list[str],
    time: str,
    arrival: str,
    province: str,
    threshold: int = 100,
    size: str = "1 hour",
    step: str = "5 seconds",
    utc_offset: str = "8 hours",
) -> tuple[DataFrame, DataFrame]:
    """Clicks per province and sliding window without those of blacklisted keys, and the alerts."""
    passed, warned = alerts.blacklist_filter(clicks, key, time, [arrival], threshold, utc_offset)
    return windows.slide_panes(passed, [province], time, size, step, n=("count", "*")), warned


def login_risk(
    df: DataFrame,
    user: str,
    time: str,
    arrival: str,
    fails: Column,
    pair_within: str = "2 seconds",
    pattern_within: str = "5 seconds",
    burst_within: str = "2 seconds",
) -> DataFrame:
    """Three detectors of repeated failures on one log, told apart by ``detector``."""
    pairs = alerts.login_fail_pairs(df, [user], time, [arrival], fails, pair_within)
    found = patterns.pattern_consecutive(df, [user], time, arrival, fails, 2, pattern_within)
    bursts = alerts.login_fail_burst(df, [user], time, arrival, fails, burst_within)
    return union_all(
        pairs.select(user, F.lit("pair").alias("detector"), F.col("previous_time").alias("since"), F.col(time).alias("until")),
        found.select(user, F.lit("pattern").alias("detector"), F.col("first_time").alias("since"), F.col(time).alias("until")),
        bursts.select(user, F.lit("burst").alias("detector"), F.col("first_time").alias("since"), F.col("last_time").alias("until")),
    )


def order_timeout(
    df: DataFrame, key: str, time: str, arrival: str, is_create: Column, is_pay: Column, within: str = "15 minutes"
) -> DataFrame:
    """Paid, unpaid and orphan orders by timer rule, and by sequence pattern."""
    by_timer = alerts.order_pay_monitor(df, key, time, arrival, is_create, is_pay, within)
    by_pattern = patterns.pattern_followed_by(df, [key], time, arrival, is_create, is_pay, within)
    return by_timer.unionByName(
        by_pattern.select(
            key,
            F.concat(F.lit("pattern_"), "kind").alias("kind"),
            F.col("begin_time").alias("create_time"),
            F.col("then_time").alias("pay_time"),
        )
    )


def reconcile_report(
    pays: DataFrame,
    receipts: DataFrame,
    key: str,
    pay_time: str,
    receipt_time: str,
    lower: str,
    upper: str,
    kinds: tuple[str, str, str],
) -> DataFrame:
    """Payments against receipts three ways, as row counts."""
    inside = joins.interval_join(pays, receipts, key, pay_time, receipt_time, lower, upper)
    outer = joins.reconcile_outer(pays, receipts, key, pay_time, receipt_time, lower, upper, kinds)
    firsts = receipts.groupBy(key).agg(F.min(receipt_time).alias(receipt_time))
    matched = joins.match_join(pays, firsts, key, pay_time, receipt_time)
    n = F.count(F.lit(1)).alias("n")
    return union_all(
        inside.agg(n).select(F.lit("interval").alias("method"), F.lit("matched").alias("kind"), "n"),
        outer.groupBy("kind").agg(n).select(F.lit("outer").alias("method"), "kind", "n"),
        matched.agg(n).select(F.lit("key").alias("method"), F.lit("matched").alias("kind"), "n"),
    )


def channel_stats(df: DataFrame, channel: str, behavior: str) -> DataFrame:
    return aggregates.concat_key_count(df, [channel, behavior])

"""Detectors over the history of a key."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators import sequence as seq
from millrace.operators.sequence import rows_per_slice, sequence, ticks, ticks_of
from millrace.operators.watermark import span
from millrace.session import stored


def no_drop_alert(df: DataFrame, keys: list[str], time: str, arrival: str, value: str, wait: str) -> DataFrame:
    """Alert each ``wait`` during which a key's value did not drop.

    A drop closes the stretch; the next row that does not drop starts a new
    one.  Alerts fall on start + k * wait, strictly before the closing drop; a
    stretch still open at the end of the input runs to the last event time.
    """
    rows = sequence(df, keys, [time, arrival]).running(_before=seq.previous(value))
    drops = F.coalesce(F.col(value) < F.col("_before"), F.lit(False))
    rows = rows.mapped(lambda d: d.withColumns({"_drop": drops, "_at": ticks(df, time)}))
    rows = rows.running(_stretch=seq.tally(F.col("_drop")))
    rows = rows.reversed().running(_closing=seq.latest(F.when(F.col("_drop"), F.col("_at"))).before())
    stretches = rows.df.groupBy(*keys, "_stretch").agg(
        F.min(F.when(~F.col("_drop"), F.struct("_at", time))).alias("_start"),
        F.max("_closing").alias("_closing"),
    )
    horizon = df.agg(F.max(ticks(df, time))).first()[0] or 0
    # The drop itself cancels an alert due at the same instant; the horizon does not.
    last = F.coalesce(F.col("_closing") - 1, F.lit(horizon))
    alerts = F.floor((last - F.col("_start._at")) / F.lit(micros(wait))).cast("bigint")
    nth = F.when(alerts >= 1, F.sequence(F.lit(1).cast("bigint"), alerts))
    return (
        stretches.select(*keys, F.col(f"_start.{time}").alias("since"), F.explode(nth).alias("nth"))
        .withColumn("alert_time", F.col("since") + F.expr(f"nth * interval {micros(wait)} microseconds"))
    )


def blacklist_filter(
    df: DataFrame,
    keys: list[str],
    time: str,
    order: list[str],
    threshold: int,
    utc_offset: str = "0 hours",
) -> tuple[DataFrame, DataFrame]:
    """Drop the rows of a key from the ``threshold``-th of a local day on.

    Returns the rows that pass and one alert per key and day, at the
    threshold row.  Counting restarts at local midnight; the first row of a
    day always passes.
    """
    local_day = F.to_date(F.col(time) + span(utc_offset)).alias("local_day")
    rows = sequence(df.select("*", local_day), [*keys, "local_day"], order)
    counted = rows.running(nth=seq.tally()).df
    passed = counted.where((F.col("nth") < threshold) | (F.col("nth") == 1))
    alerts = counted.where(F.col("nth") == max(threshold, 2))
    return passed, alerts.select(*keys, "local_day", *[c for c in (time, *order) if c not in keys])


def login_fail_pairs(
    df: DataFrame, keys: list[str], time: str, order: list[str], fails: Column, within: str
) -> DataFrame:
    """Failures whose previous row of the key is also a failure at most ``within`` apart."""
    rows = sequence(df.withColumn("_fails", fails), keys, order)
    rows = rows.running(_before=seq.previous(F.struct(F.col("_fails").alias("fails"), F.col(time).alias("t"))))
    gap = F.abs(ticks(df, time) - ticks_of(F.col("_before.t"), df.schema[time].dataType.typeName()))
    pairs = rows.df.where(F.col("_fails") & F.col("_before.fails") & (gap <= micros(within)))
    return pairs.withColumn("previous_time", F.col("_before.t")).drop("_fails", "_before")


def login_fail_burst(
    df: DataFrame,
    keys: list[str],
    time: str,
    arrival: str,
    fails: Column,
    within: str,
    at_least: int = 2,
) -> DataFrame:
    """Failures collected from a first one for ``within``; a success in that span clears them.

    Bursts of a key do not overlap: the next one starts at the first failure
    after the previous span.  Most bursts stand alone and are found by one
    group-by.  Only where failures chain on for longer than the span does the
    start of a burst depend on the one before.  Such a chain is walked in one
    task if it is small, and resolved by following "next start" links with
    doubling strides if it is not.
    """
    width = micros(within)
    rows = sequence(df.withColumns({"_fails": fails, "_at": ticks(df, time)}), keys, [time, arrival])
    rows = rows.running(_before=seq.previous(F.struct("_fails", "_at")))
    opens = F.col("_fails") & (
        F.col("_before").isNull()
        | ~F.col("_before._fails")
        | (F.col("_at") - F.col("_before._at") > width)
    )
    rows = rows.running(_chain=seq.tally(opens))
    rows = rows.reversed().running(_cleared=seq.latest(F.when(~F.col("_fails"), F.col("_at"))).before())
    # Four jobs read the failures; the scans behind them run once.
    failures = stored(rows.df.where("_fails").select(*keys, "_chain", "_cleared", "_at", time), "failures")

    place = [*keys, "_chain"]
    chains = failures.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_at").alias("_from"),
        F.max("_at").alias("_to"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.max("_cleared").alias("_cleared"),
    )
    limit = rows_per_slice(df.sparkSession)
    is_long = F.col("_to") - F.col("_from") > width
    longest, spans = (
        chains.where(is_long).agg(F.max("n"), F.max((F.col("_to") - F.col("_from")) / width)).first()
    )
    bursts = chains.where(~is_long).drop("_to")
    if longest:
        # A chain that fits one task is walked there; only larger ones need the distributed form.
        short = failures.join(chains.where(is_long & (F.col("n") <= limit)).select(*place), place, "left_semi")
        bursts = bursts.unionByName(short.groupBy(*place).applyInPandas(_walk(place, time, width), bursts.schema))
    if longest and longest > limit:
        huge = chains.where(is_long & (F.col("n") > limit))
        bursts = bursts.unionByName(_split_chains(failures, huge, spans, place, time, width))
    kept = F.col("_cleared").isNull() | (F.col("_cleared") > F.col("_from") + width)
    return bursts.where(kept & (F.col("n") >= at_least)).select(*keys, "first_time", "last_time", "n")


def _walk(place: list[str], time: str, width: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Cut one chain of bounded size into bursts."""

    def cut(chain: pd.DataFrame) -> pd.DataFrame:
        chain = chain.sort_values("_at")
        ats, begins = chain["_at"].to_numpy(), [0]
        while (after := int(np.searchsorted(ats, ats[begins[-1]] + width, side="right"))) < len(ats):
            begins.append(after)
        ends = np.array([*begins[1:], len(ats)])
        bursts = chain.iloc[begins][[*place, "_cleared"]].copy()
        bursts["n"], bursts["_from"] = ends - begins, ats[begins]
        bursts["first_time"] = chain[time].to_numpy()[begins]
        bursts["last_time"] = chain[time].to_numpy()[ends - 1]
        return bursts[[*place, "n", "_from", "first_time", "last_time", "_cleared"]]

    return cut


def _split_chains(
    failures: DataFrame, long: DataFrame, spans: float, place: list[str], time: str, width: int
) -> DataFrame:
    """Bursts of chains of any size, at most ``spans`` spans long."""
    out = [*place, "n", "_from", "first_time", "last_time", "_cleared"]
    members = failures.join(long.select(*place), place, "left_semi")
    # Failures at the same instant act alike, so links join instants.
    instants = members.groupBy(*place, "_at").agg(F.count(F.lit(1)).alias("_rows"))
    probes = instants.select(*place, (F.col("_at") + width).alias("_spot"), F.col("_at").alias("_start"))
    real = instants.select(*place, F.col("_at").alias("_spot"), F.col("_at").alias("_found"))
    # Walking backwards, a probe at start + width meets the first failure after it.
    # At equal instants the probe comes first, so that a failure on the edge stays inside.
    both = probes.unionByName(real, allowMissingColumns=True)
    both = both.withColumn("_is_probe", F.when(F.col("_start").isNotNull(), 1).otherwise(0))
    walk = sequence(both, place, ["_spot", "_is_probe"], descending=True)
    links = (
        walk.running(_next=seq.latest("_found"))
        .df.where("_is_probe = 1 and _next is not null")
        .select(*place, F.col("_start").alias("_at"), "_next")
    )
    links = stored(links, "burst-links")
    starts = long.select(*place, F.col("_from").alias("_at"))
    # A chain of k spans has at most k + 1 starts; each round doubles the stride.
    rounds = int(spans + 1).bit_length()
    for nth in range(1, rounds + 1):
        reached = starts.join(links, [*place, "_at"]).select(*place, F.col("_next").alias("_at"))
        starts = stored(starts.unionByName(reached).distinct(), "burst-starts")
        if nth < rounds:
            far = links.select(*place, F.col("_at").alias("_next"), F.col("_next").alias("_far"))
            strides = links.join(far, [*place, "_next"]).select(*place, "_at", F.col("_far").alias("_next"))
            links = stored(strides, "burst-links")
    marks = starts.withColumn("_starts", F.lit(True))
    owned = members.join(marks, [*place, "_at"], "left")
    owner = sequence(owned, place, ["_at"]).running(
        peers=True, _from=seq.latest(F.when(F.col("_starts"), F.col("_at")))
    )
    return (
        owner.df.groupBy(*place, "_from")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
            F.max("_cleared").alias("_cleared"),
        )
        .select(*out)
    )


def order_pay_monitor(
    df: DataFrame,
    key: str,
    time: str,
    arrival: str,
    is_create: Column,
    is_pay: Column,
    within: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Whether orders are paid in time, in event-time order.

    ``paid``: pay follows the create within the span, both ends included;
    ``no_pay``: the span of a create ended first; ``pay_without_create``: a pay
    that found no live create (none, already paid, or timed out).  A further
    create before the end of the span takes the place of the earlier one. Columns to
    ``keep`` are those of the row that decides.
    """
    steps = df.where(is_create | is_pay).select(key, time, arrival, is_create.alias("_create"))
    place = F.struct(F.col("_create").alias("create"), F.col(time).alias("t"))
    rows = sequence(steps, [key], [time, arrival]).running(_before=seq.previous(place))
    rows = rows.reversed().running(_next=seq.previous(time)).df
    live = F.coalesce(
        F.col("_before.create") & (F.col(time) <= F.col("_before.t") + span(within)), F.lit(False)
    )
    ended = F.col("_next").isNull() | (F.col("_next") > F.col(time) + span(within))
    kind = (
        F.when(F.col("_create"), F.when(ended, "no_pay"))
        .when(live, "paid")
        .otherwise("pay_without_create")
    )
    states = rows.withColumn("kind", kind).where("kind is not null")
    created = F.when(F.col("_create"), F.col(time)).when(F.col("kind") == "paid", F.col("_before.t"))
    return states.select(
        key, "kind", created.alias("create_time"), F.when(~F.col("_create"), F.col(time)).alias("pay_time"), *(keep or [])
    )

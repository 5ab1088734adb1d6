"""Exact per-row event-time watermarks over a finite, arrival-ordered input.

A row is judged by the watermark it meets: the largest event time among the
rows that arrived before it, minus the delay.  A window is closed once its
end is at or below the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence
from millrace.operators.windows import slide, slide_panes


def span(duration: str) -> Column:
    return F.expr(f"interval {micros(duration)} microseconds")


def watermark_replay(df: DataFrame, time: str, arrival: str, delay: str, name: str = "watermark") -> DataFrame:
    """Add the watermark each row meets; null before the first row."""
    rows = sequence(df, [], [arrival]).running(_seen=seq.highest(time).before()).df
    return rows.withColumn(name, F.col("_seen") - span(delay)).drop("_seen")


def wm_punctuated(df: DataFrame, time: str, arrival: str, delay: str) -> DataFrame:
    """The watermark emitted after each row, one per row."""
    rows = sequence(df, [], [arrival]).running(_seen=seq.highest(time)).df
    return rows.withColumn("watermark", F.col("_seen") - span(delay)).drop("_seen")


def _is_open(end: Column, lateness: str) -> Column:
    mark = F.col("watermark")
    return mark.isNull() | (end + span(lateness) > mark)


def late_side_output(
    df: DataFrame,
    time: str,
    arrival: str,
    size: str,
    delay: str,
    step: str | None = None,
    lateness: str = "0 seconds",
) -> tuple[DataFrame, DataFrame]:
    """Rows some window still takes, and rows all of whose windows are closed for good."""
    seen = watermark_replay(df, time, arrival, delay)
    # The last window holding a row starts at the row's own step.
    last_start = F.window(time, step or size)["start"]
    judged = seen.withColumn("_start", last_start)
    taken = _is_open(F.col("_start") + span(size), lateness)
    return judged.where(taken).drop("_start"), judged.where(~taken).drop("_start")


def allowed_lateness(
    df: DataFrame,
    keys: list[str],
    time: str,
    arrival: str,
    size: str,
    delay: str,
    lateness: str,
    value: str,
) -> DataFrame:
    """Every result a tumbling window gives out.

    ``firing`` 0 is the on-time result; each row that comes after the window
    closed, but within ``lateness``, fires the window again with the updated
    sum and count.
    """
    seen = watermark_replay(df, time, arrival, delay)
    window = F.window(time, size)
    placed = seen.withColumns({"window_start": window["start"], "window_end": window["end"]})
    group = [*keys, "window_start", "window_end"]
    on_time = _is_open(F.col("window_end"), "0 seconds")
    first = (
        placed.where(on_time)
        .groupBy(*group)
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    )
    late = placed.where(~on_time & _is_open(F.col("window_end"), lateness))
    again = sequence(late, group, [arrival]).running(
        firing=seq.tally(), _late_total=seq.total(value)
    ).df
    base = first.select(*group, F.col("total").alias("_total"), F.col("n").alias("_n"))
    refired = again.join(base, group, "left").select(
        *group,
        "firing",
        (F.coalesce("_total", F.lit(0)) + F.col("_late_total")).alias("total"),
        (F.coalesce("_n", F.lit(0)) + F.col("firing")).alias("n"),
    )
    return first.select(*group, F.lit(0).cast("bigint").alias("firing"), "total", "n").unionByName(refired)


def late_sliding_counts(
    df: DataFrame,
    key: str,
    time: str,
    arrival: str,
    size: str,
    step: str,
    delay: str,
    lateness: str,
    name: str = "cnt",
) -> DataFrame:
    """Final count per key and sliding window when late rows update a window
    for ``lateness`` after it closed.

    Rows that every one of their windows still takes go through panes; only
    the few later ones are copied per window and checked against each.
    """
    seen = watermark_replay(df.select(key, time, arrival), time, arrival, delay)
    first_end = F.window(time, step)["end"]
    judged = seen.withColumn("_first_end", first_end)
    early = _is_open(F.col("_first_end"), lateness)
    panes = slide_panes(judged.where(early), [key], time, size, step, cnt=("count", "*"))
    tardy = slide(judged.where(~early), [key, "watermark"], time, size, step, cnt=F.count(F.lit(1)))
    tardy = tardy.where(_is_open(F.col("window_end"), lateness))
    parts = [d.select(key, "window_start", "window_end", "cnt") for d in (panes, tardy)]
    return (
        parts[0].unionByName(parts[1]).groupBy(key, "window_start", "window_end").agg(F.sum("cnt").alias(name))
    )

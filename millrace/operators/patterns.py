"""Event sequences per key, in event-time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence
from millrace.operators.watermark import span


def pattern_consecutive(
    df: DataFrame,
    keys: list[str],
    time: str,
    arrival: str,
    condition: Column,
    times: int,
    within: str,
) -> DataFrame:
    """``times`` directly adjacent rows that satisfy the condition in less than ``within``.

    Overlapping matches are all reported, one row each: the last row of the
    match with ``first_time`` and ``first_<arrival>``.
    """
    hits = df.withColumn("_hit", F.when(condition, 1).otherwise(0))
    rows = sequence(hits, keys, [time, arrival]).bounded(
        times - 1,
        _hits=lambda w: F.sum("_hit").over(w.rowsBetween(-(times - 1), 0)),
        _first=lambda w: F.lag(F.struct(F.col(time).alias("t"), F.col(arrival).alias("a")), times - 1).over(w),
    )
    matched = rows.df.where(
        (F.col("_hits") == times) & (F.col(time) < F.col("_first.t") + span(within))
    )
    return matched.withColumns(
        {"first_time": F.col("_first.t"), f"first_{arrival}": F.col("_first.a")}
    ).drop("_hit", "_hits", "_first")


def pattern_followed_by(
    df: DataFrame,
    keys: list[str],
    time: str,
    arrival: str,
    begin: Column,
    then: Column,
    within: str,
) -> DataFrame:
    """For each ``begin`` row the first later ``then`` row of the key, others may lie between.

    ``kind`` is ``matched`` when it comes in less than ``within``, otherwise
    ``timeout`` with the instant at which the wait ended.
    """
    marked = df.withColumns({"_begin": begin, "_then": then}).where("_begin or _then")
    ahead = sequence(marked, keys, [time, arrival]).reversed()
    answer = F.when(F.col("_then"), F.struct(F.col(time).alias("t"), F.col(arrival).alias("a")))
    # Walking backwards, the latest answer met so far is the next one in time.
    rows = ahead.running(_next=seq.latest(answer).before()).df.where("_begin")
    in_time = F.coalesce(F.col("_next.t") < F.col(time) + span(within), F.lit(False))
    return rows.select(
        *keys,
        F.col(arrival).alias(f"begin_{arrival}"),
        F.col(time).alias("begin_time"),
        F.when(in_time, F.col("_next.a")).alias(f"then_{arrival}"),
        F.when(in_time, F.col("_next.t")).alias("then_time"),
        F.when(in_time, "matched").otherwise("timeout").alias("kind"),
        F.when(~in_time, F.col(time) + span(within)).alias("timeout_time"),
    )


def pattern_timeout(matches: DataFrame) -> DataFrame:
    """The partial matches whose wait ended, with that instant."""
    return matches.where(F.col("kind") == "timeout").drop("kind", "then_time")



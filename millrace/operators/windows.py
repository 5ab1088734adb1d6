"""Time windows, sessions and row-count windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence, ticks, ticks_of


def _flat(df: DataFrame, keys: list[str], window: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, window)]
    return df.select(
        *keys, F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def tumble(df: DataFrame, keys: list[str], time: str, size: str, **aggregates: Column) -> DataFrame:
    """Aggregate per key and fixed window; without keys, per window.  Batch or stream."""
    grouped = df.groupBy(*keys, F.window(time, size).alias("window"))
    return _flat(grouped.agg(*[a.alias(n) for n, a in aggregates.items()]), keys)


def slide(df: DataFrame, keys: list[str], time: str, size: str, step: str, **aggregates: Column) -> DataFrame:
    """Aggregate per key and overlapping window.  Each row is copied size/step times;
    prefer ``slide_panes`` for mergeable aggregates and a large ratio."""
    grouped = df.groupBy(*keys, F.window(time, size, step).alias("window"))
    return _flat(grouped.agg(*[a.alias(n) for n, a in aggregates.items()]), keys)


# Aggregates that can be merged from panes, with the aggregate that merges them.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def slide_panes(
    df: DataFrame, keys: list[str], time: str, size: str, step: str, **aggregates: tuple[str, str]
) -> DataFrame:
    """Overlapping windows from panes, for batch input.

    Rows are aggregated once per pane of width ``step`` and only the few pane
    rows are copied into the size/step windows that cover them, so the copies
    no longer grow with the data.  Aggregates are given as
    ``name=("sum", "column")``; a ``count`` takes ``"*"``.
    """
    ratio, rest = divmod(micros(size), micros(step))
    if rest:
        plain = {n: _plain(how, column) for n, (how, column) in aggregates.items()}
        return slide(df, keys, time, size, step, **plain)
    pane = df.groupBy(*keys, F.window(time, step).alias("_pane")).agg(
        *[_plain(how, column).alias(n) for n, (how, column) in aggregates.items()]
    )
    # A window that covers the pane ends 0 .. ratio-1 steps after it.  Windows are put into
    # blocks of consecutive ends, so that each pane is sent to one or two blocks, not to
    # each of its windows; it is copied per window only where the block is added up.
    block = 4 * ratio
    first_end = F.floor(ticks_of(F.col("_pane.end"), _kind(df, time)) / F.lit(micros(step))).cast("bigint")
    blocks = F.sequence(F.floor(F.col("_end") / block), F.floor((F.col("_end") + ratio - 1) / block))
    sent = pane.withColumn("_end", first_end).withColumn("_block", F.explode(blocks))
    sent = sent.repartition(*keys, "_block")
    low = F.greatest(F.col("_end"), F.col("_block") * block)
    high = F.least(F.col("_end") + ratio - 1, F.col("_block") * block + block - 1)
    copies = sent.withColumn("_to", F.explode(F.sequence(low, high)))
    out = copies.groupBy(*keys, "_block", "_to").agg(
        *[_MERGE[how](n).alias(n) for n, (how, _) in aggregates.items()]
    )
    end = _time_at(F.col("_to") * micros(step), _kind(df, time))
    start = _time_at(F.col("_to") * micros(step) - micros(size), _kind(df, time))
    return out.select(*keys, start.alias("window_start"), end.alias("window_end"), *aggregates)


def _kind(df: DataFrame, time: str) -> str:
    return df.schema[time].dataType.typeName()


def _time_at(at: Column, kind: str) -> Column:
    """Microseconds as a time of the given type."""
    if kind == "timestamp":
        return F.timestamp_micros(at)
    return F.timestamp_add("MICROSECOND", at, F.lit("1970-01-01").cast("timestamp_ntz"))


def _plain(how: str, column: str) -> Column:
    return F.count(F.lit(1)) if column == "*" else getattr(F, how)(column)


def session(df: DataFrame, keys: list[str], time: str, gap: str, **aggregates: Column) -> DataFrame:
    """Sessions closed by a silence longer than ``gap``; rows exactly one gap apart merge.

    Batch or stream, by the built-in session window.
    """
    grouped = df.groupBy(*keys, F.session_window(time, gap).alias("window"))
    return _flat(grouped.agg(*[a.alias(n) for n, a in aggregates.items()]), keys)


def session_hot(
    df: DataFrame, keys: list[str], time: str, arrival: str, gap: str, **aggregates: Column
) -> DataFrame:
    """Sessions for batch input whose keys may be very large.

    The built-in session window sorts a whole key in one task.  Here a session
    starts where the previous row is more than a gap away; numbering the
    starts and grouping by that number needs no task to see a whole key.
    """
    df = df.where(F.col(time).isNotNull())  # as the built-in window does
    rows = sequence(df, keys, [time, arrival])
    if not rows.sliced:
        return session(df, keys, time, gap, **aggregates)
    at = ticks(df, time)
    rows = rows.running(_before=seq.previous(at))
    starts = F.col("_before").isNull() | (at - F.col("_before") > micros(gap))
    rows = rows.running(_session=seq.tally(starts))
    return (
        rows.df.groupBy(*keys, "_session")
        .agg(
            F.min(time).alias("window_start"),
            (F.max(time) + F.expr(f"interval {micros(gap)} microseconds")).alias("window_end"),
            *[a.alias(n) for n, a in aggregates.items()],
        )
        .drop("_session")
    )


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "nth") -> seq.Sequence:
    """Position of each row within its key, from 1."""
    return sequence(df, keys, order).running(**{name: seq.tally()})


def count_tumble(df: DataFrame, keys: list[str], order: list[str], size: int, **aggregates: Column) -> DataFrame:
    """Every ``size`` rows of a key; an unfilled group is never emitted."""
    rows = numbered(df, keys, order, "_nth").df
    group = F.floor((F.col("_nth") - 1) / size).alias("window_no")
    filled = rows.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("_rows"), *[a.alias(n) for n, a in aggregates.items()]
    )
    return filled.where(F.col("_rows") == size).drop("_rows")


def count_slide(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    size: int,
    step: int,
    first_full: bool = False,
    **aggregates: Callable[[Window], Column],
) -> DataFrame:
    """Every ``step`` rows of a key over its last ``size`` rows.

    The first firings see fewer rows.  With ``first_full`` (the relational
    variant) nothing is emitted before a key has ``size`` rows; the following
    firings come every ``step`` rows after that.
    """
    rows = numbered(df, keys, order)
    rows = rows.bounded(
        size - 1,
        **{n: _last_rows(make, size) for n, make in aggregates.items()},
    )
    nth = F.col("nth")
    fires = (nth >= size) & ((nth - size) % step == 0) if first_full else nth % step == 0
    return rows.df.where(fires)


def _last_rows(make: Callable, size: int) -> Callable:
    return lambda w: make(w.rowsBetween(-(size - 1), 0))


def eager_window(
    df: DataFrame, keys: list[str], time: str, arrival: str, size: str, **columns: seq.Running
) -> DataFrame:
    """A window that fires at every row: the result so far of (key, window) after each row."""
    placed = df.withColumn("window_start", F.window(time, size)["start"])
    return sequence(placed, [*keys, "window_start"], [arrival]).running(**columns).df

"""Joins of two inputs by key and time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators import sequence as seq
from millrace.operators.sequence import BROADCAST_ROWS, sequence, ticks


def match_join(left: DataFrame, right: DataFrame, key: str, left_arrival: str, right_arrival: str) -> DataFrame:
    """Pair the rows of two inputs one to one: the n-th arrival of a key on one side with its n-th on the other.

    ``completed_by`` tells which side came second and so completed the pair.
    """
    second = F.when(F.col(left_arrival) > F.col(right_arrival), "left").otherwise("right")
    kind = left.schema[left_arrival].dataType
    sides = [
        df.where(F.col(key).isNotNull()).select(key, F.col(at).cast(kind).alias("_at"), F.lit(side).alias("_side"), F.struct(
            *[c for c in df.columns if c != key]).alias(f"_{side}"))
        for side, df, at in (("l", left, left_arrival), ("r", right, right_arrival))
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    # Both sides are numbered in one walk, and its partitioning serves the pairing, so the rows are shuffled once.
    counts = {f"_n{side}": seq.tally(F.col("_side") == side) for side in "lr"}
    rows = sequence(both, [key], ["_at", "_side"]).running(**counts).df
    nth = F.when(F.col("_side") == "l", F.col("_nl")).otherwise(F.col("_nr")).alias("_nth")
    pairs = rows.groupBy(key, nth).agg(*[F.first(f"_{s}", ignorenulls=True).alias(f"_{s}") for s in "lr"])
    met = pairs.where("_l is not null and _r is not null").select(key, "_l.*", "_r.*")
    return met.withColumn("completed_by", second)


def _once(df: DataFrame, time: str, width: int) -> DataFrame:
    """Each row in the one bucket of its time; rows without a time stay, in none."""
    return df.withColumn("_bucket", F.floor(ticks(df, time) / F.lit(width)).cast("bigint"))


def _copied(df: DataFrame, time: str, lowest: int, highest: int, width: int) -> DataFrame:
    """Each row in the at most two buckets that the interval around its time touches; rows without a time match nothing."""
    at = ticks(df, time)
    first = F.floor((at + F.lit(lowest)) / F.lit(width)).cast("bigint")
    last = F.floor((at + F.lit(highest)) / F.lit(width)).cast("bigint")
    return df.withColumn("_bucket", F.explode(F.sequence(first, last)))


def _within(df: DataFrame, left_time: str, right_time: str, lower: int, upper: int) -> Column:
    """right time in [left + lower, left + upper], in microseconds, ends included."""
    return F.expr(
        f"`{right_time}` between `{left_time}` + interval {lower} microseconds "
        f"and `{left_time}` + interval {upper} microseconds"
    )


def signed(duration: str) -> int:
    return -micros(duration[1:]) if duration.startswith("-") else micros(duration)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    bucketed: bool = True,
) -> DataFrame:
    """Inner join on the key where the right time lies in [left+lower, left+upper].

    A time bucket as wide as the interval is part of the join key, so the rows of
    one key spread over many tasks.  Streams (with a watermark on both sides)
    take ``bucketed=False``.
    """
    low, high = signed(lower), signed(upper)
    on = [key]
    if bucketed:
        width = max(high - low, 1)
        left, right = _copied(left, left_time, low, high, width), _once(right, right_time, width)
        on.append("_bucket")
    paired = left.join(right, on).where(_within(left, left_time, right_time, low, high))
    return paired.drop("_bucket")


def negated(duration: str) -> str:
    return duration[1:] if duration.startswith("-") else f"-{duration}"


def in_reach(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, lower: str, upper: str, how: str = "left_semi"
) -> DataFrame:
    """The left rows with a right row in the interval of ``interval_join`` (``left_semi``), or without one (``left_anti``); ``both``
    gives all of them and tells which in ``_met``.

    One walk per key and bucket and one shuffle of both sides: a left row at the end of its interval sees the newest right time up to there.
    """
    low, high = signed(lower), signed(upper)
    width = max(high - low, 1)
    mine = _once(left, left_time, width).withColumns({"_at": ticks(left, left_time) + F.lit(high), "_rt": F.lit(None).cast("long")})
    other = right.where(F.col(key).isNotNull()).select(key, right_time)
    other = _copied(other, right_time, -high, -low, width).select(key, "_bucket", *[ticks(other, right_time).alias(c) for c in ("_at", "_rt")])
    both = mine.withColumn("_mine", F.lit(True)).unionByName(other.withColumn("_mine", F.lit(False)), allowMissingColumns=True)
    newest = F.max("_rt").over(Window.partitionBy(key, "_bucket").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0))
    seen = both.withColumn("_met", F.coalesce(newest >= F.col("_at") - F.lit(high - low), F.lit(False))).where("_mine")
    seen = seen.withColumn(key, F.col(key).cast(left.schema[key].dataType)).drop("_bucket", "_at", "_rt", "_mine")
    return seen if how == "both" else seen.where(F.col("_met") if how == "left_semi" else ~F.col("_met")).drop("_met")


def reconcile_outer(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    kinds: tuple[str, str, str] = ("matched", "left_only", "right_only"),
    bucketed: bool = True,
) -> DataFrame:
    """Interval join that keeps the unmatched rows of both sides, told apart by ``kind``.

    Rows with a null key or time, and rows that occur several times, are kept one by one.
    """
    low, high = signed(lower), signed(upper)
    inside = _within(left, left_time, right_time, low, high)
    out_columns = [key, *[c for c in (*left.columns, *right.columns) if c != key]]
    right_key = right.withColumnRenamed(key, "_rk")
    same = (F.col(key) == F.col("_rk")) & inside
    if not bucketed:
        kind = F.when(F.col("_l") & F.col("_r"), kinds[0]).when(F.col("_l"), kinds[1]).otherwise(kinds[2])
        joined = left.withColumn("_l", F.lit(True)).join(right_key.withColumn("_r", F.lit(True)), same, "full_outer")
        return joined.withColumn(key, F.coalesce(key, "_rk")).select(*out_columns, kind.alias("kind"))

    # The side that is kept lies in one bucket and the other is copied, once for each side, so no row needs an identity.
    width = max(high - low, 1)
    at = same & (F.col("_bucket") == F.col("_other"))
    other = _copied(right_key, right_time, -high, -low, width).withColumnRenamed("_bucket", "_other").withColumn("_r", F.lit(True))
    of_left = _once(left, left_time, width).join(other, at, "left").select(
        *out_columns, F.when(F.col("_r"), kinds[0]).otherwise(kinds[1]).alias("kind")
    )
    other = _copied(left, left_time, low, high, width).withColumnRenamed("_bucket", "_other")
    alone = _once(right_key, right_time, width).join(other, at, "left_anti").withColumnRenamed("_rk", key)
    missing = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c != key]
    return of_left.unionByName(alone.drop("_bucket").select("*", *missing, F.lit(kinds[2]).alias("kind")))


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, prefix: str = "r_") -> DataFrame:
    """Left outer equi-join; right columns are renamed so that no name occurs twice."""
    renamed = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns])
    return left.join(renamed, left[left_key] == renamed[f"{prefix}{right_key}"], "left")


def left_join_streams(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    retention: str,
    prefix: str = "r_",
) -> DataFrame:
    """Streaming left join whose rows wait ``retention`` for one another.

    Both sides need a watermark; the retention becomes the time bound after
    which the join state is dropped.
    """
    renamed = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns])
    bound = _within(left, left_time, f"{prefix}{right_time}", -micros(retention), micros(retention))
    return left.join(renamed, (F.col(key) == F.col(f"{prefix}{key}")) & bound, "left_outer")


def control_broadcast(
    data: DataFrame, control: DataFrame, arrival: str, switch: str, name: str = "switch_value"
) -> DataFrame:
    """Each data row with the newest value of a control input at its arrival."""
    fed = data.withColumn("_switch", F.lit(None).cast(control.schema[switch].dataType))
    marks = control.select(arrival, F.col(switch).alias("_switch"), F.lit(True).alias("_control"))
    both = fed.withColumn("_control", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    rows = sequence(both, [], [arrival]).running(**{name: seq.latest("_switch")}).df
    return rows.where(~F.col("_control")).drop("_switch", "_control")


def lookup_join(df: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a lookup table; it is broadcast only if its measured row count is small."""
    bounded = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(small) if bounded else small, key, how)


def lateral_rows(df: DataFrame, make: Callable[[DataFrame], Column], out: str) -> DataFrame:
    """Cross each row with the array that ``make`` derives from it."""
    return df.select("*", F.explode(make(df)).alias(out))

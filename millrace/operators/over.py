"""OVER windows: running and bounded frames per key or over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence


def over_unbounded_global(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Running sum over the whole table, without putting it into one partition."""
    return sequence(df, [], order).running(**{name: seq.total(value)}).df


def over_unbounded_peers(df: DataFrame, keys: list[str], time: str, **columns: seq.Running) -> DataFrame:
    """Running values ordered by event time; rows of the same time are peers."""
    return sequence(df, keys, [time]).running(peers=True, **columns).df


def over_rows(df: DataFrame, keys: list[str], order: list[str], preceding: int, **aggregates: Column) -> DataFrame:
    """Aggregates over the current row and ``preceding`` rows before it."""

    def framed(aggregate: Column):
        return lambda w: aggregate.over(w.rowsBetween(-preceding, 0))

    rows = sequence(df, keys, order)
    return rows.bounded(preceding, **{n: framed(a) for n, a in aggregates.items()}).df


def row_number_by(df: DataFrame, group: list[str], by: list[Column], name: str = "row_num") -> DataFrame:
    """Rank inside a group.  ``by`` must end in a tie-break.

    Follow it with ``name <= n``: Spark then keeps only n rows per group and
    task before the shuffle.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*by)))


def prev_value_jump(
    df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float, name: str = "previous_value"
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than ``threshold``."""
    rows = sequence(df, keys, order).running(**{name: seq.previous(value)}).df
    return rows.where(F.abs(F.col(value) - F.col(name)) > threshold)

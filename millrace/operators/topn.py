"""Rankings: best rows per group, per window and so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import sequence as seq
from millrace.operators.over import row_number_by
from millrace.operators.sequence import sequence
from millrace.operators.windows import slide_panes


def top_n(df: DataFrame, group: list[str], by: list[Column], n: int, name: str = "row_num") -> DataFrame:
    return row_number_by(df, group, by, name).where(F.col(name) <= n)


def hot_items(df: DataFrame, item: str, time: str, size: str, step: str, n: int) -> DataFrame:
    """The ``n`` most frequent items of each sliding window; ties go to the smaller item."""
    counts = slide_panes(df, [item], time, size, step, cnt=("count", "*"))
    return top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col(item).asc()], n)


def running_top(
    df: DataFrame, keys: list[str], order: list[str], value: str, n: int = 3, name: str = "top"
) -> DataFrame:
    """After each row the key's ``n`` highest rows so far, highest first, as columns top1..topN.

    A row first competes for place one; the loser of that contest competes for
    place two, and so on, so each place is a running maximum of the losers of
    the place above.  ``order`` must end in a unique column; of two equal
    values the earlier row ranks first.
    """
    arrival = order[-1]
    # Negated arrival makes the earlier of two equal values the larger struct.
    entry = F.struct(F.col(value).alias("value"), (-F.col(arrival)).alias("age"))
    rows = sequence(df.withColumn("_entry", entry), keys, order)
    for place in range(1, n + 1):
        rows = rows.running(
            **{f"_p{place}": seq.highest("_entry"), "_held": seq.highest("_entry").before()}
        )
        loser = F.when(F.col("_entry") > F.col("_held"), F.col("_held")).otherwise(
            F.when(F.col("_held").isNotNull(), F.col("_entry"))
        )
        rows = rows.mapped(lambda d, loser=loser: d.withColumn("_entry", loser).drop("_held"))
    out = rows.df.drop("_entry")
    columns = {}
    for place in range(1, n + 1):
        columns[f"{name}{place}"] = F.col(f"_p{place}")["value"]
        columns[f"{name}{place}_{arrival}"] = -F.col(f"_p{place}")["age"]
    return out.withColumns(columns).drop(*[f"_p{p}" for p in range(1, n + 1)])

"""Row-wise work: mapping, filtering, routing, merging and distributing rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_record(df: DataFrame, **columns: Column) -> DataFrame:
    """One output row per input row."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
    teardown: Callable[[object], None] | None = None,
) -> DataFrame:
    """1:1 map in Arrow batches with a resource opened once per task.

    For work that needs a handle (a model, a client); anything that is an
    expression belongs in ``map_record``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        handle = setup()
        try:
            for batch in batches:
                yield apply(handle, batch)
        finally:
            if teardown:
                teardown(handle)

    return df.mapInPandas(run, schema)


def split_rows(df: DataFrame, column: str, separator: str, out: str = "word") -> DataFrame:
    """One row per piece of ``column``; the separator is taken literally."""
    keep = [c for c in df.columns if c != column]
    pieces = F.split(F.col(column), _literal(separator))
    return df.select(*keep, F.explode(pieces).alias(out))


def _literal(separator: str) -> str:
    return "\\Q" + separator + "\\E"


def flatmap_tokens(df: DataFrame, column: str) -> DataFrame:
    """Line to (word, 1) pairs, split at single spaces."""
    return split_rows(df.select(column), column, " ").withColumn("n", F.lit(1).cast("bigint"))


def flatmap_fields(df: DataFrame, column: str) -> DataFrame:
    """Line to one row per comma-separated field."""
    return split_rows(df.select(column), column, ",", out="field")


def filter_map(df: DataFrame, keep: Column, **columns: Column) -> DataFrame:
    """Filter and project in one step."""
    return map_record(df.where(keep), **columns)


def split_stream(
    df: DataFrame, condition: Column, side_columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Main output where the condition holds, projected side output elsewhere.

    Rows whose condition is null go to the side, so nothing is lost.
    """
    is_main = F.coalesce(condition, F.lit(False))
    side = df.where(~is_main)
    return df.where(is_main), side.select(*side_columns) if side_columns else side


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Merge tables of the same columns; duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def heterogeneous_map(
    left: DataFrame, left_map: dict[str, Column], right: DataFrame, right_map: dict[str, Column]
) -> DataFrame:
    """Two inputs of different types, each with its own projection, as one output."""
    return map_record(left, **left_map).unionByName(map_record(right, **right_map))


def tagged_union(left: DataFrame, right: DataFrame, tag: str = "side") -> DataFrame:
    """Two inputs side by side in one schema, for keyed work over both."""
    return left.withColumn(tag, F.lit("l")).unionByName(
        right.withColumn(tag, F.lit("r")), allowMissingColumns=True
    )


def distribute(df: DataFrame, mode: str, parts: int | None = None, key: str | None = None) -> DataFrame:
    """Choose how rows spread over tasks.

    ``hash`` by key, ``rebalance`` round robin, ``random`` by a fresh random
    number.  Sending a whole table to one task (``global``) is only meant for
    a result that is already small, such as a report of a few rows.
    """
    count = [parts] if parts else []
    if mode == "hash":
        return df.repartition(*count, key)
    if mode == "rebalance":
        return df.repartition(*(count or [df.sparkSession.sparkContext.defaultParallelism]))
    if mode == "random":
        return df.repartition(*count, F.rand())
    if mode == "global":
        return df.repartition(1)  # its own exchange; coalesce would pull the work before it into the one task
    raise ValueError(f"unknown mode {mode!r}")

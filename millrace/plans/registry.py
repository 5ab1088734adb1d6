"""Where queries over the shared tables are registered, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` computes the same rows independently."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# Out-of-order event time, derived from the arrival-ordered table in the same way on both sides.
SHIFTED_SQL = "ts - to_minutes(event_id * 7919 % 97)"


def shifted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an event time ``et`` up to 96 minutes behind the arrival time."""
    return events(spark, sf_dir).selectExpr("*", "ts - make_interval(0,0,0,0,0,(event_id * 7919) % 97) as et")

"""Registered queries of this subpackage, with SQL twins where SQL can express them."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

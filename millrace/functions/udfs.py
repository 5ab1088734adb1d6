"""User-written functions: scalar, table and aggregate forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pandas.core.groupby import SeriesGroupBy
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from millrace.operators.aggregates import user_aggregate
from millrace.operators.topn import top_n


@F.pandas_udf(IntegerType())
def text_length(text: pd.Series) -> pd.Series:
    """Characters of a text, in Arrow batches."""
    return text.str.len().astype("Int32")


@F.udtf(returnType=StructType([StructField("word", StringType())]))
class SplitWords:
    """One output row per piece of a text."""

    def eval(self, text: str, separator: str = "_") -> Iterator[tuple[str]]:
        if text is not None:
            for word in text.split(separator):
                yield (word,)


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL as ``my_length`` and ``split_words``."""
    spark.udf.register("my_length", text_length)
    spark.udtf.register("split_words", SplitWords)


def udaf_avg(df: DataFrame, keys: list[str], value: str, name: str = "average") -> DataFrame:
    """Average written as an accumulator of (sum, count)."""

    def accumulate(groups: SeriesGroupBy) -> dict[str, pd.Series]:
        return {"sum": groups.sum(), "count": groups.count()}

    fields = {"sum": "sum", "count": "sum"}
    whole = df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long")
    types = {"sum": "bigint" if whole else "double", "count": "bigint"}
    return user_aggregate(df, keys, value, fields, accumulate, F.col("sum") / F.col("count"), name, types)


def average(value: Column | str) -> Column:
    """The same accumulator on the JVM; this form also runs on streams."""
    return F.sum(value) / F.count(value)


def udtaf_top2(df: DataFrame, keys: list[str], value: str, arrival: str) -> DataFrame:
    """Table aggregate: a group's two highest values as rows TOP1 and TOP2.

    Equal values take both places; a group of one row gives one row.
    """
    ranked = top_n(df.where(F.col(value).isNotNull()), keys, [F.col(value).desc(), F.col(arrival).asc()], 2)
    return ranked.select(*keys, value, F.concat(F.lit("TOP"), F.col("row_num")).alias("rank"))

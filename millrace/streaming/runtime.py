"""Running a streaming frame to the end of its present input, and event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sequence import ticks
from millrace.session import ROCKSDB, scratch
from millrace.sinks.writers import UpsertTable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
UNIX_START = "timestamp_ntz'1970-01-01 00:00:00'"


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet table (one file or a directory) read file by file as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A glob makes the source accept a single file as well as a directory; this one matches the path alone.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def instant(df: DataFrame, column: str) -> Column:
    """A zone-less time as a timestamp, which watermarks require."""
    return F.timestamp_micros(ticks(df, column))


def wall(column: str) -> Column:
    """Back from a timestamp to the zone-less time it was made from."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({column}), {UNIX_START})")


def with_event_time(df: DataFrame, column: str, delay: str, name: str | None = None) -> DataFrame:
    """Declare the event time and the bounded disorder: watermark = largest time - delay.

    A delay of ``0 seconds`` is the ascending-timestamps case.
    """
    name = name or column
    return df.withColumn(name, instant(df, column)).withWatermark(name, delay)


def unix_times(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps of a streaming result as zone-less times."""
    return df.withColumns({c: wall(c) for c in columns})


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """RocksDB for keyed state; a local session with the default of 200 state
    partitions uses one per core instead."""
    old = {name: spark.conf.get(name, None) for name in (PROVIDER, PARTITIONS)}
    spark.conf.set(PROVIDER, ROCKSDB)
    context = spark.sparkContext
    if context.master.startswith("local") and old[PARTITIONS] in (None, "200"):
        spark.conf.set(PARTITIONS, context.defaultParallelism)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_to_files(
    df: DataFrame, label: str, mode: str = "append", form: str = "parquet", path: str | None = None
) -> DataFrame:
    """Run to the end of the available input into files, exactly once; read the result back."""
    spark = df.sparkSession
    base = path or scratch(spark, label)
    with state_settings(spark):
        writer = df.writeStream.format(form).option("path", f"{base}/data")
        running = writer.option("checkpointLocation", f"{base}/checkpoint").outputMode(mode)
        running.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).format(form).load(f"{base}/data")


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], base: str, mode: str = "append") -> None:
    """Run to the end of the available input, handing every micro-batch to ``each``."""
    with state_settings(df.sparkSession):
        writer = df.writeStream.foreachBatch(each).option("checkpointLocation", f"{base}/checkpoint")
        writer.outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def run_to_upsert(
    df: DataFrame, keys: list[str], label: str, order: list[str] | None = None, mode: str = "update"
) -> DataFrame:
    """Keep the newest row per key of an updating result."""
    base = scratch(df.sparkSession, label)
    target = UpsertTable(df.sparkSession, f"{base}/table", keys, order or [])
    run_batches(df, target.merge, base, mode)
    return target.read()

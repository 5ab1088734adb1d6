"""Streaming sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from millrace.sinks.writers import kafka_messages


def to_console(stream: DataFrame, mode: str = "append", rows: int = 20) -> DataStreamWriter:
    return stream.writeStream.format("console").outputMode(mode).option("numRows", rows).option("truncate", "false")


def to_csv(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """CSV files, each row exactly once."""
    writer = stream.writeStream.format("csv").option("path", path)
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def to_kafka(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, key: Column | str | None = None
) -> DataStreamWriter:
    writer = kafka_messages(stream, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)


def to_table(stream: DataFrame, name: str, checkpoint: str) -> DataStreamWriter:
    """Insert-select on a stream; start it with ``.toTable(name)``."""
    return stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").queryName(name)

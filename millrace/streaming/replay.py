"""Tables and file folders as time-ordered streams that lose nothing and end with everything given out.

A streaming join or window forgets what its watermark has passed, so the order in which files reach it matters. ``write_replay`` lays a
table out in numbered steps, cut at percentiles of the event time, each written after the one before; a file source reads them in
that order. All steps have the same number of files, and a micro-batch takes that many: a step each, so their number depends neither on
the size of the table nor on the cluster. ``measured_delay`` gives the watermark delay that a folder of files needs, whatever their
order: how far a row can lie behind the largest time of the steps read before it. With that delay no row is late.

Structured Streaming has no end of input: what waits for the watermark would wait for ever. ``flush`` therefore adds one last
row per input, whose time lies beyond everything that still waits. One is enough for all keys and state partitions, as the watermark is
one value per query. It opens nothing that the watermark could close again, so it never reaches an append-mode result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import micros
from millrace.operators.sequence import ticks, ticks_of
from millrace.session import scratch
from millrace.streaming.runtime import table_stream, with_event_time

STEPS = 4


@dataclass(frozen=True)
class Replay:
    """A folder that is read in the order of modification, step by step: ``files_per_step`` files at a time."""

    spark: SparkSession
    path: str
    schema: T.StructType
    time: str
    delay: str
    files_per_step: int = 1

    def stream(self, steps_per_batch: int = 1) -> DataFrame:
        return table_stream(self.spark, self.path, self.schema, steps_per_batch * self.files_per_step)

    def timed(self, steps_per_batch: int = 1) -> DataFrame:
        """The stream with its event time and the watermark it needs."""
        return with_event_time(self.stream(steps_per_batch), self.time, self.delay)

    def last(self) -> int | None:
        """The largest time in microseconds."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.agg(F.max(ticks(rows, self.time))).first()[0]

    def flush(self, beyond: str = "0 seconds", last: int | None = None, exact: bool = False, **values: object) -> Replay:
        """The same folder with one more row, ``beyond`` the last time plus the delay; ``values`` fill its other columns.

        After it the watermark stands at the last time plus ``beyond``, rounded up to a millisecond unless ``exact``, because the built-in
        watermark is kept in milliseconds. Inputs of one query take the ``last`` time of them all. A join key needs a value that
        occurs nowhere else, on no side: Spark may drop a row without a key before it sees its time.
        """
        last = self.last() if last is None else last
        if last is not None:
            at = last + micros(self.delay) + micros(beyond)
            at = at if exact else -(-at // 1000) * 1000
            _last_row(self.spark, self.schema, self.time, at, values).write.mode("append").parquet(self.path)
        return self


def _last_row(spark: SparkSession, schema: T.StructType, time: str, at: int, values: Mapping[str, object]) -> DataFrame:
    start = "timestamp_ntz'1970-01-01 00:00:00'"
    stamp = F.timestamp_micros(F.lit(at)) if schema[time].dataType.typeName() == "timestamp" else F.expr(
        f"timestampadd(MICROSECOND, {at}, {start})")
    return spark.range(1).coalesce(1).select(*[
        (stamp if f.name == time else F.lit(values.get(f.name))).cast(f.dataType).alias(f.name) for f in schema.fields])


def measured_delay(spark: SparkSession, path: str, schema: T.StructType, time: str, files_per_step: int = 1) -> str:
    """The delay with which no row of a folder is late, if its files are read in the order of modification, one or more steps at a time.

    Files written in the same millisecond may be read in either order; that is allowed for. Files without rows take their places too.
    """
    rows = spark.read.schema(schema).parquet(path)
    known = rows.select("_metadata.file_path", ticks(rows, time).alias("at")).groupBy("file_path").agg(
        F.min("at").alias("least"), F.max("at").alias("most"))
    listed = spark.read.format("binaryFile").load(path).select(
        "_metadata.file_path", F.unix_millis("_metadata.file_modification_time").alias("ms"))  # no contents are read
    in_order = Window.orderBy("ms")  # a row per file
    files = listed.join(known, "file_path", "left").withColumns(
        {"first": F.rank().over(in_order) - 1, "last": F.count(F.lit(1)).over(in_order) - 1})
    # A file's rows may have been seen from the first step it can fall in on; they are judged in the last one at the latest.
    none = F.lit(None).cast("long")
    turns = files.select(F.explode(F.array(
        F.struct(F.expr(f"first div {files_per_step}").alias("step"), "most", none.alias("least")),
        F.struct(F.expr(f"last div {files_per_step}").alias("step"), none.alias("most"), "least"))).alias("t")).select("t.*")
    before = F.max("most").over(Window.orderBy("step").rangeBetween(Window.unboundedPreceding, -1))
    most = turns.select((before - F.col("least")).alias("behind")).agg(F.max("behind")).first()[0]
    # A time that equals the watermark has been passed by it, so the delay must be larger than that.
    return f"{0 if most is None or most < 0 else most // 1000 + 1} milliseconds"


def write_replay(df: DataFrame, time: str, steps: int = STEPS, step: Column | None = None) -> Replay:
    """Lay a table out as ``steps`` numbered parts in event-time order; rows without a time come first.

    ``step`` (a number from 0) may give the parts instead. The rows are shuffled once, to their part. Each step is written as the same
    number of files, the mean of what its rows need, so that a file is no larger than ``steps`` splits; a step with fewer splits is
    spread once more, and one with fewer rows than that gets files without rows.
    """
    spark = df.sparkSession
    path, parts = scratch(spark, "replay"), scratch(spark, "replay-parts")
    if step is None:
        at = ticks_of(F.col(time), df.schema[time].dataType.typeName())
        shares = [F.lit(i / steps) for i in range(1, steps)]
        cuts = df.agg(F.percentile_approx(at, F.array(*shares), F.lit(10_000)).alias("c")).first()["c"] if shares else None
        step = sum(((F.coalesce(at, F.lit(-(2**63))) > c).cast("int") for c in cuts or []), F.lit(0))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(_tasks(spark, steps)))
    df.withColumn("_part", step.cast("int")).repartition("_part", spread).write.partitionBy("_part").parquet(parts)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField("_part", T.IntegerType())])).parquet(parts)
    parted = [whole.where(F.col("_part") == n).drop("_part") for n in range(steps)]
    splits = [part.rdd.getNumPartitions() for part in parted]
    files = max(1, sum(splits) // steps)
    for n, (part, found) in enumerate(zip(parted, splits, strict=True), 1):
        (part.coalesce(files) if found >= files else part.repartition(files)).write.mode("append").parquet(path)
        written = len(spark.read.schema(schema).parquet(path).inputFiles())
        for _ in range(n * files - written):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return Replay(spark, path, schema, time, measured_delay(spark, path, schema, time, files), files)


def _tasks(spark: SparkSession, steps: int) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // steps)


def open_replay(spark: SparkSession, path: str, time: str, schema: T.StructType | None = None) -> Replay:
    """A folder of files in any order as a stream with the delay that it needs."""
    schema = schema or spark.read.parquet(path).schema
    return Replay(spark, path, schema, time, measured_delay(spark, path, schema, time))

"""Streaming forms that work per micro-batch and carry a small result to the next.

A running value over a whole stream has no key to spread it by.  Each
micro-batch is scanned in slices by the batch operator, and only its one-row
summary is carried on, in a folder per batch id: a batch that is repeated after
a failure overwrites its own folder and reads only those of earlier batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import joins
from millrace.operators import sequence as seq
from millrace.operators.project import split_stream as split
from millrace.operators.sequence import sequence
from millrace.operators.topn import top_n
from millrace.operators.watermark import span
from millrace.session import scratch
from millrace.sinks.writers import jdbc_options
from millrace.streaming.runtime import run_batches, run_to_upsert


class Carried:
    """Rows that each batch leaves for the batches after it.

    Batch ids follow one another without gaps, so a result that sums up all
    batches so far is read from the folder of the batch before (``last``);
    ``before`` gives what all earlier batches left.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, T.StructType.fromDDL(schema)

    def last(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id - 1}")

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        kept = self.spark.read.schema(full).option("basePath", self.path).parquet(f"{self.path}/batch_id=*")
        return kept.where(F.col("batch_id") < batch_id).drop("batch_id")

    def leave(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def _store(rows: DataFrame, base: str, name: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")


def _stored(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}").drop("batch_id")


def running_total(stream: DataFrame, arrival: str, value: Column, name: str) -> DataFrame:
    """Running sum over a whole stream in arrival order."""
    spark = stream.sparkSession
    base = scratch(spark, name)
    carried = Carried(spark, f"{base}/carried", "v double")

    def each(batch: DataFrame, batch_id: int) -> None:
        start = carried.last(batch_id).agg(F.coalesce(F.sum("v"), F.lit(0.0))).first()[0]
        fed = batch.withColumn("_v", value.cast("double"))
        rows = sequence(fed, [], [arrival]).running(**{name: seq.total("_v")}).df
        _store(rows.withColumn(name, F.col(name) + F.lit(start)).drop("_v"), base, "rows", batch_id)
        upto = F.coalesce(F.sum("_v"), F.lit(0.0)) + F.lit(start)
        carried.leave(fed.agg(upto.alias("v")), batch_id)

    run_batches(stream, each, base)
    return _stored(spark, base, "rows")


def running_count(stream: DataFrame, arrival: str, name: str = "nth") -> DataFrame:
    """Ordinal of each row of a stream."""
    counted = running_total(stream, arrival, F.lit(1), name)
    return counted.withColumn(name, F.col(name).cast("bigint"))


def running_distinct(stream: DataFrame, value: str, arrival: str, name: str = "uv") -> DataFrame:
    """How many different values a stream has shown, after each row."""
    spark = stream.sparkSession
    base = scratch(spark, name)
    seen = Carried(spark, f"{base}/seen", f"{value} {stream.schema[value].dataType.simpleString()}")

    def each(batch: DataFrame, batch_id: int) -> None:
        known = seen.before(batch_id)
        firsts = batch.groupBy(value).agg(F.min(arrival).alias(arrival)).where(F.col(value).isNotNull())
        fresh = firsts.join(known, value, "left_anti")
        marks = fresh.select(arrival, F.lit(1).cast("bigint").alias("_new"))
        fed = batch.join(marks, arrival, "left").fillna({"_new": 0})
        rows = sequence(fed, [], [arrival]).running(**{name: seq.total("_new")}).df.drop("_new")
        _store(rows.withColumn(name, F.col(name) + F.lit(known.count())), base, "rows", batch_id)
        seen.leave(fresh, batch_id)

    run_batches(stream, each, base)
    return _stored(spark, base, "rows")


def split_late(
    stream: DataFrame, time: str, size: str, delay: str, lateness: str = "0 seconds", step: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Main rows and late rows of a stream, judged by the watermark of the earlier batches.

    The built-in watermark drops such rows silently; here they are kept apart
    before any aggregation sees them.
    """
    spark = stream.sparkSession
    base = scratch(spark, "late")
    kind = stream.schema[time].dataType.simpleString()
    progress = Carried(spark, f"{base}/progress", f"t {kind}")

    def each(batch: DataFrame, batch_id: int) -> None:
        newest = progress.last(batch_id).agg(F.max("t").alias("_newest"))
        # One row by construction, so the broadcast is bounded.
        judged = batch.withColumn("_one", F.lit(1)).join(F.broadcast(newest.withColumn("_one", F.lit(1))), "_one")
        last_end = F.window(time, step or size)["start"] + span(size)
        judged = judged.withColumn("_end", last_end)
        late = F.coalesce(F.col("_end") + span(lateness) <= F.col("_newest") - span(delay), F.lit(False))
        helpers = ("_one", "_newest", "_end")
        _store(judged.where(~late).drop(*helpers), base, "main", batch_id)
        _store(judged.where(late).drop(*helpers), base, "side", batch_id)
        times = batch.select(F.col(time).alias("t")).unionByName(progress.last(batch_id))
        progress.leave(times.agg(F.max("t").alias("t")), batch_id)

    run_batches(stream, each, base)
    return _stored(spark, base, "main"), _stored(spark, base, "side")


def split_stream(stream: DataFrame, condition: Column, side_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Route the rows of a stream to a main and a side output in one query."""
    spark = stream.sparkSession
    base = scratch(spark, "split")

    def each(batch: DataFrame, batch_id: int) -> None:
        main, side = split(batch, condition, side_columns)
        _store(main, base, "main", batch_id)
        _store(side, base, "side", batch_id)

    run_batches(stream, each, base)
    return _stored(spark, base, "main"), _stored(spark, base, "side")


def label_by_control(stream: DataFrame, control: DataFrame, arrival: str, switch: str, name: str) -> DataFrame:
    """Data rows with the newest control value at their arrival.

    Each batch reads the control rows of its own span and the newest one before it.
    """
    spark = stream.sparkSession
    base = scratch(spark, "control")
    number = F.col(arrival)

    def each(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min(arrival), F.max(arrival)).first()
        inside = control.where(number.between(first, last)).select(arrival, switch)
        newest = control.where(number < first).agg(F.max_by(switch, arrival).alias(switch), F.max(arrival).alias(arrival))
        marks = inside.unionByName(newest.where(number.isNotNull()))
        _store(joins.control_broadcast(batch, marks, arrival, switch, name), base, "rows", batch_id)

    run_batches(stream, each, base)
    return _stored(spark, base, "rows")


def rank_updates(counts: DataFrame, keys: list[str], window: str, by: list[str], n: int) -> DataFrame:
    """Top ``n`` per window from an updating count: newest count per key and window, then ranked."""
    newest = run_to_upsert(counts, [*keys, window], "ranked")
    order = [F.col(by[0]).desc(), *[F.col(k).asc() for k in by[1:]]]
    return top_n(newest, [window], order, n)


def append_jdbc(stream: DataFrame, url: str, table: str, base: str, **options: str) -> None:
    """Append a stream to a database table, batch by batch; needs the driver on the class path.

    At least once: a batch that failed between insert and commit is inserted again. Where that matters, give the table a
    unique key or use a keyed upsert table.
    """
    settings = jdbc_options(url, table, **options)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**settings).mode("append").save()

    run_batches(stream, each, base)

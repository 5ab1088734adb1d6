"""Sinks for batch frames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import latest_per_key


def show(df: DataFrame, rows: int = 20, label: str = "") -> None:
    if label:
        print(label)
    df.show(rows, truncate=False)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("append").option("sep", separator).csv(path)


def kafka_messages(df: DataFrame, key: Column | str | None = None, form: str = "json") -> DataFrame:
    """Rows as (key, value) messages in JSON or CSV."""
    body = F.to_json(F.struct("*")) if form == "json" else F.to_csv(F.struct("*"))
    if key is None:
        return df.select(body.alias("value"))
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), body.alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str, key: Column | str | None = None) -> None:
    """Send rows to a topic; without a key the producer spreads them over the partitions."""
    sink = kafka_messages(df, key).write.format("kafka")
    sink.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def jdbc_options(url: str, table: str, driver: str | None = None, batch_rows: int = 1000, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    if driver:
        options["driver"] = driver
    return {**options, **extra}


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()


def with_random_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Rows under a generated id, for append-only sinks that need one."""
    return df.select(F.expr("uuid()").alias(name), "*")


def append_random_id(df: DataFrame, path: str, name: str = "doc_id") -> None:
    with_random_id(df, name).write.mode("append").parquet(path)


def insert_select(spark: SparkSession, target: str, source: str, condition: str) -> None:
    """Fill a table from a filtered source in one statement."""
    spark.sql(f"INSERT INTO {target} SELECT * FROM {source} WHERE {condition}")


class UpsertTable:
    """A keyed table on plain files: the last row of each key wins.

    Each write adds the batch's newest row per key in its own folder
    ``batch_id=N``, so it costs as much as the batch, not as the table, and a
    repeated batch overwrites its own folder only.  Reading resolves the
    versions with one partial aggregate.

    Every ``SNAPSHOT`` batches the versions so far are resolved once into a
    snapshot beside the table, and a manifest names it when it is complete.
    Readers take the newest snapshot that is named and the batches after it, so
    they touch a bounded number of versions.  Nothing is deleted: a reader that
    began earlier goes on with what it has seen.
    """

    SNAPSHOT = 16

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str]):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        # Without an order a key occurs once per batch, as in an updating result.
        newest = latest_per_key(batch, self.keys, self.order) if self.order else batch
        newest.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if (batch_id + 1) % self.SNAPSHOT == 0:
            whole = self._resolved(self._versions(upto=batch_id))
            whole.write.mode("overwrite").parquet(f"{self.path}.snapshots/{batch_id}")
            named = self.spark.range(1).coalesce(1).select(F.lit(batch_id).cast("long").alias("upto"))
            named.write.mode("append").parquet(f"{self.path}.manifest")

    def snapshot(self) -> int | None:
        """The last batch that the newest complete snapshot holds."""
        try:
            names = self.spark.read.schema("upto long").parquet(f"{self.path}.manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return names.agg(F.max("upto")).first()[0]

    def _versions(self, upto: int | None = None) -> DataFrame:
        # Folders of batches before the snapshot are pruned by their name.
        parts, whole = self.spark.read.parquet(self.path), self.snapshot()
        if upto is not None and whole is not None and whole >= upto:  # the batch is repeated
            whole = whole - self.SNAPSHOT if whole >= self.SNAPSHOT else None
        parts = parts.where(F.col("batch_id") <= upto) if upto is not None else parts
        if whole is None:
            return parts
        kept = self.spark.read.parquet(f"{self.path}.snapshots/{whole}")
        return kept.unionByName(parts.where(F.col("batch_id") > whole))

    def _resolved(self, versions: DataFrame) -> DataFrame:
        return latest_per_key(versions, self.keys, [*self.order, "batch_id"])

    def read(self) -> DataFrame:
        return self._resolved(self._versions()).drop("batch_id")

    def compact(self, path: str) -> UpsertTable:
        """The same table at a new path in one version; the old path is left as it is."""
        self.read().write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id=-1")
        return UpsertTable(self.spark, path, self.keys, self.order)

"""Sources: collections, text, delimited and log lines, tables, message topics.

Each decoder works on a frame with a text column, so it serves a batch file,
a directory stream and a topic alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalar import field, parse_time

CORRUPT = "_corrupt"
# Positions of an access-log line split at spaces, and its time format.
WEB_LOG_FIELDS = {"ip": 0, "user": 1, "time": 3, "method": 5, "url": 6}
WEB_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def from_records(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A typed frame of records held by the program, such as a small lookup list."""
    return spark.createDataFrame(rows, schema)


def read_text(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One row per line in column ``value``; any Hadoop file-system URI."""
    return spark.read.options(**options).text(path)


def stream_lines(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded line stream: each file that appears in the directory is read once."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Typed rows of a delimited file; malformed lines are kept in ``_corrupt``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("sep", separator).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def decode_delimited(
    df: DataFrame, schema: T.StructType, column: str = "value", separator: str = ","
) -> DataFrame:
    """Lines to typed columns; malformed lines are kept in ``_corrupt``.  Batch or stream."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in df.columns if c != column]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    return df.select(*rest, F.from_csv(F.col(column), ddl, options).alias("_r")).select(*rest, "_r.*")


def decode_json(df: DataFrame, schema: T.StructType | str, column: str = "value", rejects: bool = False) -> DataFrame:
    """JSON messages to typed columns.  A message that is not JSON gives nulls; with ``rejects`` its text is kept in ``_corrupt``."""
    rest = [c for c in df.columns if c != column]
    if not rejects:
        return df.select(*rest, F.from_json(F.col(column), schema).alias("_r")).select(*rest, "_r.*")
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    full = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(*rest, F.from_json(F.col(column), full, options).alias("_r")).select(*rest, "_r.*")


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def decode_web_log(
    df: DataFrame,
    column: str = "value",
    time_format: str = WEB_LOG_TIME,
    method: str | None = "GET",
    keep: list[str] | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Space-separated access-log lines to (ip, user, time, method, url), one method only.

    ``keep`` names columns beside the line that stay, such as the arrival. With ``rejects`` a line without a url or with a time that
    cannot be read, of whatever method, is kept in ``_corrupt``; otherwise it has nulls or is left out.
    """
    part = {n: field(column, " ", i) for n, i in WEB_LOG_FIELDS.items()}
    wanted = F.lit(True) if method is None else part["method"] == method
    corrupt = []
    if rejects:
        bad = part["url"].isNull() | parse_time(part["time"], time_format).isNull()
        corrupt, wanted = [F.when(bad, F.col(column)).alias(CORRUPT)], bad | wanted
    return df.where(wanted).select(
        *(keep or []),
        part["ip"].alias("ip"),
        part["user"].alias("user"),
        parse_time(part["time"], time_format).alias("time"),
        part["method"].alias("method"),
        part["url"].alias("url"),
        *corrupt,
    )


def kafka_options(
    servers: str, topic: str, starting: str = "latest", group: str | None = None, **extra: str
) -> dict[str, str]:
    """Reader options for a topic; ``starting`` is ``latest`` or ``earliest``."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    return {**options, **extra}


def kafka_stream(spark: SparkSession, **options: str) -> DataFrame:
    """Messages of a topic as text in ``value``; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def table_file(spark: SparkSession, name: str, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """A delimited file with a declared schema, registered as a view."""
    df = spark.read.schema(schema).option("sep", separator).csv(path)
    df.createOrReplaceTempView(name)
    return df


def register_source(
    spark: SparkSession,
    name: str,
    schema: T.StructType | str,
    options: dict[str, str],
    event_time: tuple[str, Column] | None = None,
    delay: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """Declare a source table: schema, connector options, computed event time, watermark.

    ``options`` holds ``format``, ``path`` and reader options; ``event_time``
    names a computed time column and its expression; ``delay`` is the
    watermark delay of a stream.
    """
    rest = {k: v for k, v in options.items() if k not in ("format", "path")}
    reader = (spark.readStream if stream else spark.read).format(options["format"])
    reader = reader.schema(schema).options(**rest)
    df = reader.load(options["path"]) if "path" in options else reader.load()
    if event_time:
        df = df.withColumn(*event_time)
    if event_time and delay and stream:
        df = df.withWatermark(event_time[0], delay)
    df.createOrReplaceTempView(name)
    return df


def catalog_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A table of the session's catalog."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    return spark.table(name)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Register a frame, batch or stream, as a view for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)

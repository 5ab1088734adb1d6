"""Queries of sources, sinks and row-wise operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalar, udfs
from millrace.operators import project
from millrace.operators.aggregates import changelog
from millrace.operators.joins import lookup_join
from millrace.operators.sequence import tally, total
from millrace.plans.registry import events, query, table
from millrace.session import scratch
from millrace.sinks import writers
from millrace.sources import readers, schemas


def csv_lines(spark, sf_dir):
    """The events as delimited text: id, epoch seconds, whole value; every tenth line is JSON instead."""
    line = F.concat_ws(",", F.concat(F.lit("u"), "user_id"), _seconds("ts"), F.floor("value").cast("string"))
    text = F.when(F.col("event_id") % 10 == 9, F.col("props")).otherwise(line)
    return events(spark, sf_dir).select("event_id", text.alias("value"))


def _seconds(time):
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {time})").cast("string")


# ------------------------------------------------------------------------- sources

@query("src_collection", """
    SELECT e.event_type, c.label, count(*) AS n
    FROM events e JOIN (VALUES ('view', 'browse'), ('click', 'browse'), ('purchase', 'buy')) c(event_type, label)
      USING (event_type) GROUP BY ALL""")
def src_collection(spark, sf_dir):
    kinds = readers.from_records(
        spark, [("view", "browse"), ("click", "browse"), ("purchase", "buy")], "event_type string, label string"
    )
    joined = lookup_join(events(spark, sf_dir), kinds, "event_type", "inner")
    return joined.groupBy("event_type", "label").agg(F.count(F.lit(1)).alias("n"))


@query("src_text", """
    SELECT length(line) AS chars, count(*) AS n FROM (
      SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def src_text(spark, sf_dir):
    path = scratch(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = readers.read_text(spark, path, lineSep="\n")
    return lines.groupBy(F.length("value").cast("bigint").alias("chars")).agg(F.count(F.lit(1)).alias("n"))


SENSOR_SQL = """
    SELECT event_id, 'u' || user_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, CAST(floor(value) AS INTEGER) AS vc
    FROM events WHERE event_id % 10 <> 9"""


@query("src_delimited", SENSOR_SQL)
def src_delimited(spark, sf_dir):
    return readers.good_rows(readers.decode_delimited(csv_lines(spark, sf_dir), schemas.WATER_SENSOR))


@query("src_delimited_corrupt", """
    SELECT props AS _corrupt, count(*) AS n FROM events WHERE event_id % 10 = 9 GROUP BY 1""")
def src_delimited_corrupt(spark, sf_dir):
    decoded = readers.decode_delimited(csv_lines(spark, sf_dir), schemas.WATER_SENSOR)
    return readers.corrupt_rows(decoded).groupBy("_corrupt").agg(F.count(F.lit(1)).alias("n"))


def log_lines(spark, sf_dir):
    """Access-log lines of the events: clicks are POST, the rest GET."""
    return events(spark, sf_dir).select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
            F.col("user_id").cast("string"),
            F.lit("-"),
            F.date_format("ts", readers.WEB_LOG_TIME),
            F.lit("+0000"),
            F.when(F.col("event_type") == "click", "POST").otherwise("GET"),
            F.concat(F.lit("/item/"), F.get_json_object("props", "$.k")),
        ).alias("value")
    )


@query("src_web_log", """
    SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS "user",
           CAST(floor(epoch(ts)) AS BIGINT) AS seconds, 'GET' AS method,
           '/item/' || json_extract_string(props, '$.k') AS url
    FROM events WHERE event_type <> 'click'""")
def src_web_log(spark, sf_dir):
    log = readers.decode_web_log(log_lines(spark, sf_dir))
    return log.select("ip", "user", F.unix_seconds(F.col("time").cast("timestamp")).alias("seconds"), "method", "url")


@query("src_web_log_rejects", """
    SELECT CASE WHEN event_id % 7 = 0 THEN 'no time' ELSE 'cut off' END AS what, count(*) AS n FROM events
    WHERE event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1
    UNION ALL SELECT 'good', count(*) FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_type <> 'click'""")
def src_web_log_rejects(spark, sf_dir):
    # Lines whose time is no time, and lines that end early; both are kept, whatever their method.
    whole = events(spark, sf_dir).select("event_id", F.when(F.col("event_type") == "click", "POST").otherwise("GET").alias("method"), "ts")
    time = F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.date_format("ts", readers.WEB_LOG_TIME))
    line = F.concat_ws(" ", F.lit("10.0.0.1"), F.lit("u"), F.lit("-"), time, F.lit("+0000"),
                       F.when(F.col("event_id") % 11 != 0, F.concat_ws(" ", "method", F.lit("/a"))))
    log = readers.decode_web_log(whole.select(line.alias("value")), rejects=True)
    what = F.when(F.col(readers.CORRUPT).isNull(), "good").when(F.col(readers.CORRUPT).contains(" soon "), "no time").otherwise("cut off")
    return log.groupBy(what.alias("what")).agg(F.count(F.lit(1)).alias("n"))


@query("src_table_file", """
    SELECT 'u' || user_id AS id, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total
    FROM events WHERE event_id % 10 <> 9 GROUP BY 1""")
def src_table_file(spark, sf_dir):
    path = scratch(spark, "sensor")
    writers.write_csv(src_delimited(spark, sf_dir).drop("event_id"), path)
    readers.table_file(spark, "sensor", path, schemas.WATER_SENSOR)
    return spark.sql("SELECT id, count(*) AS n, sum(CAST(vc AS BIGINT)) AS total FROM sensor GROUP BY id")


@query("src_ddl", """
    SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events WHERE event_type = 'signup'""")
def src_ddl(spark, sf_dir):
    readers.register_source(
        spark,
        "declared_events",
        schemas.EVENT,
        {"format": "parquet", "path": f"{sf_dir}/events.parquet"},
        event_time=("rt", scalar.epoch_text_to_time(_seconds("ts").cast("bigint"))),
        delay="5 seconds",
    )
    return spark.sql(
        "SELECT user_id, unix_seconds(CAST(rt AS TIMESTAMP)) AS seconds FROM declared_events "
        "WHERE event_type = 'signup'"
    )


@query("src_catalog", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def src_catalog(spark, sf_dir):
    path, old = scratch(spark, "catalog"), spark.catalog.currentDatabase()
    name = "millrace_" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    table(spark, sf_dir, "nation").write.saveAsTable(f"{name}.nation")
    found = readers.catalog_table(spark, "nation", name)
    spark.catalog.setCurrentDatabase(old)
    return found.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("stream_to_table", "SELECT user_id, event_type, value FROM events WHERE event_type = 'view' AND value > 50")
def stream_to_table(spark, sf_dir):
    readers.as_table(events(spark, sf_dir), "event_table")
    views = spark.sql("SELECT * FROM event_table WHERE event_type = 'view'")
    return spark.sql("SELECT user_id, event_type, value FROM {t} WHERE value > 50", t=views)


# --------------------------------------------------------------------------- sinks

@query("sink_file_csv", "SELECT user_id, event_type, value FROM events WHERE event_type = 'error'")
def sink_file_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    writers.write_csv(events(spark, sf_dir).where("event_type = 'error'").select("user_id", "event_type", "value"), path)
    return spark.read.schema("user_id bigint, event_type string, value double").csv(path)


@query("sink_kafka", """
    SELECT CAST(user_id AS VARCHAR) AS key,
           '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""")
def sink_kafka(spark, sf_dir):
    return writers.kafka_messages(events(spark, sf_dir).select("event_id", "user_id", "event_type"), "user_id")


@query("sink_upsert", """
    SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
           max(event_id) AS event_id FROM events GROUP BY user_id""")
def sink_upsert(spark, sf_dir):
    target = writers.UpsertTable(spark, scratch(spark, "upsert"), ["user_id"], ["event_id"])
    rows = events(spark, sf_dir).select("user_id", "event_type", "value", "event_id")
    for batch_id in range(3):
        # Three batches that mix the keys; the second arrives twice.
        batch = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == batch_id)
        target.merge(batch, batch_id)
        if batch_id == 1:
            target.merge(batch, batch_id)
    return target.compact(scratch(spark, "compacted")).read()


@query("sink_append_random_id", """
    SELECT event_type, count(*) AS n, count(*) AS ids FROM events GROUP BY 1""")
def sink_append_random_id(spark, sf_dir):
    path = scratch(spark, "append")
    writers.append_random_id(events(spark, sf_dir).select("event_type", "value"), path)
    stored = spark.read.parquet(path)
    # Ids are 128-bit random: spread over all tasks before they are counted.
    once = stored.groupBy("event_type", "doc_id").agg(F.count(F.lit(1)).alias("c"))
    return once.groupBy("event_type").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("ids"))


@query("insert_select", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def insert_select(spark, sf_dir):
    path = scratch(spark, "insert")
    name = "sink_" + path[-32:]
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, user_id BIGINT, value DOUBLE, event_type STRING) "
              f"USING parquet LOCATION '{path}'")
    events(spark, sf_dir).select("event_id", "user_id", "value", "event_type").createOrReplaceTempView("source_events")
    writers.insert_select(spark, name, "source_events", "event_type = 'purchase'")
    return spark.table(name).drop("event_type")


@query("changelog", """
    WITH r AS (
      SELECT user_id, event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    o AS (SELECT *, lag(n) OVER w AS old_n, lag(total) OVER w AS old_total FROM r
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, event_id, true AS is_insert, n, total FROM o
    UNION ALL SELECT user_id, event_id, false, old_n, old_total FROM o WHERE old_n IS NOT NULL""")
def changelog_query(spark, sf_dir):
    changes = changelog(
        events(spark, sf_dir), ["user_id"], ["event_id"], {"n": tally(), "total": total("value")}
    )
    return changes.withColumn("total", F.round("total", 4))


# ----------------------------------------------------------- projections and routing

@query("map_record", """
    SELECT 'u' || user_id AS id, ts, CAST(floor(value) AS BIGINT) AS vc FROM events""")
def map_record(spark, sf_dir):
    return project.map_record(
        events(spark, sf_dir),
        id=F.concat(F.lit("u"), "user_id"), ts=F.col("ts"), vc=F.floor("value"),
    )


@query("map_with_setup", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def map_with_setup(spark, sf_dir):
    import re

    def parse(pattern, batch):
        k = batch["props"].str.extract(pattern, expand=False).astype("int64")
        return batch[["event_id"]].assign(k=k)

    rows = events(spark, sf_dir).select("event_id", "props")
    return project.map_with_setup(rows, lambda: re.compile(r'"k": (\d+)'), parse, "event_id bigint, k bigint")


TOKENS_SQL = """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"""


@query("flatmap_tokens", TOKENS_SQL)
def flatmap_tokens(spark, sf_dir):
    pairs = project.flatmap_tokens(table(spark, sf_dir, "documents"), "text")
    return pairs.groupBy("word").agg(F.sum("n").alias("n"))


@query("flatmap_fields", """
    SELECT field, count(*) AS n FROM (
      SELECT unnest([CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type]) AS field FROM events) GROUP BY 1""")
def flatmap_fields(spark, sf_dir):
    lines = events(spark, sf_dir).select(F.concat_ws(",", "event_id", "user_id", "event_type").alias("line"))
    return project.flatmap_fields(lines, "line").groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query("process_tokens", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def process_tokens(spark, sf_dir):
    return project.split_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", " ")


@query("filter_gt", "SELECT event_id, user_id, value FROM events WHERE value > 30")
def filter_gt(spark, sf_dir):
    return events(spark, sf_dir).where("value > 30").select("event_id", "user_id", "value")


@query("filter_eq", "SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def filter_eq(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("event_type") == "view").select("event_id", "user_id")


@query("filter_ge", "SELECT user_id, round(sum(value), 4) AS total FROM events WHERE value >= 20 GROUP BY 1")
def filter_ge(spark, sf_dir):
    kept = events(spark, sf_dir).where("value >= 20")
    return kept.groupBy("user_id").agg(F.round(F.sum("value"), 4).alias("total"))


@query("filter_map", """
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
    FROM events WHERE event_type = 'purchase'""")
def filter_map(spark, sf_dir):
    return project.filter_map(
        events(spark, sf_dir), F.col("event_type") == "purchase",
        event_id=F.col("event_id"), user_id=F.col("user_id"),
        item=scalar.as_long(F.get_json_object("props", "$.k")),
    )


@query("select_columns", "SELECT l_orderkey AS order_id, l_quantity AS quantity FROM lineitem")
def select_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("quantity"))


@query("split_stream", """
    SELECT event_id, CASE WHEN value >= 30 THEN user_id ELSE -1 END AS user_id, value,
           CASE WHEN value >= 30 THEN 'main' ELSE 'side' END AS output FROM events""")
def split_stream(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    main, side = project.split_stream(rows, F.col("value") >= 30, ["event_id", "value"])
    both = main.withColumn("output", F.lit("main")).unionByName(
        side.withColumn("output", F.lit("side")), allowMissingColumns=True
    )
    return both.withColumn("user_id", F.coalesce("user_id", F.lit(-1)))


@query("heterogeneous_map", """
    SELECT 'text' AS kind, doc_id AS id, CAST(length(text) AS BIGINT) AS n FROM documents
    UNION ALL SELECT 'number', event_id, user_id FROM events""")
def heterogeneous_map(spark, sf_dir):
    texts = {"kind": F.lit("text"), "id": F.col("doc_id"), "n": F.length("text").cast("bigint")}
    numbers = {"kind": F.lit("number"), "id": F.col("event_id"), "n": F.col("user_id")}
    return project.heterogeneous_map(table(spark, sf_dir, "documents"), texts, events(spark, sf_dir), numbers)


@query("repartition_modes", """
    SELECT mode, l_suppkey, n FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
    (VALUES ('hash'), ('rebalance'), ('random'), ('global')) m(mode)""")
def repartition_modes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey")
    parts = []
    for mode in ("hash", "rebalance", "random"):
        spread = project.distribute(lines, mode, key="l_suppkey")
        parts.append(spread.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).withColumn("mode", F.lit(mode)))
    # Only the finished report goes to one task, never the lines.
    report = project.distribute(parts[0].drop("mode"), "global").withColumn("mode", F.lit("global"))
    return project.union_all(*parts, report)


@query("union_all", """
    SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def union_all(spark, sf_dir):
    buyers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    sellers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return project.union_all(buyers, sellers)


# ----------------------------------------------------------------- scalar functions

@query("fn_split", "SELECT p_partkey, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2 FROM part")
def fn_split(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", scalar.field("p_name", " ", 0).alias("w1"), scalar.field("p_name", " ", 1).alias("w2")
    )


@query("fn_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def fn_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))


@query("fn_concat", "SELECT p_partkey, p_brand || '_' || p_size AS k FROM part")
def fn_concat(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalar.joined("p_brand", "p_size").alias("k"))


@query("fn_cast", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS INTEGER) IS NULL AS bad
    FROM events""")
def fn_cast(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", scalar.as_long(F.get_json_object("props", "$.k")).alias("k"), scalar.as_int("event_type").isNull().alias("bad")
    )


@query("fn_equals_ge_gt", """
    SELECT event_id, event_type = 'view' AS eq, value >= 50 AS ge, value > 50 AS gt FROM events""")
def fn_equals_ge_gt(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", (F.col("event_type") == "view").alias("eq"),
        (F.col("value") >= 50).alias("ge"), (F.col("value") > 50).alias("gt"),
    )


@query("fn_abs_max", """
    SELECT c_custkey, abs(c_acctbal) AS a, greatest(c_acctbal, 1000.0) AS m FROM customer""")
def fn_abs_max(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.abs("c_acctbal").alias("a"), F.greatest("c_acctbal", F.lit(1000.0)).alias("m")
    )


@query("fn_to_json", """
    SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS j FROM part""")
def fn_to_json(spark, sf_dir):
    return table(spark, sf_dir, "part").select(scalar.to_json_text("p_partkey", "p_name", "p_size").alias("j"))


@query("fn_from_json_csv", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id, event_type FROM events""")
def fn_from_json_csv(spark, sf_dir):
    lines = events(spark, sf_dir).select(
        "event_id", "props", scalar.to_csv_text("user_id", "event_type").alias("line")
    )
    decoded = readers.decode_json(lines, "k bigint", "props")
    return decoded.select("event_id", "k", F.from_csv("line", "user_id bigint, event_type string").alias("c")).select(
        "event_id", "k", "c.*"
    )


@query("fn_from_json_rejects", """
    SELECT event_id, CASE WHEN event_id % 5 > 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
           CASE WHEN event_id % 5 = 0 THEN substr(props, 1, 3) END AS _corrupt FROM events""")
def fn_from_json_rejects(spark, sf_dir):
    cut = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 3)).otherwise(F.col("props")).alias("props")
    return readers.decode_json(events(spark, sf_dir).select("event_id", cut), "k bigint", "props", rejects=True)


@query("fn_epoch_to_ts", "SELECT event_id, date_trunc('second', ts) AS t1, date_trunc('second', ts) AS t2 FROM events")
def fn_epoch_to_ts(spark, sf_dir):
    seconds = _seconds("ts").cast("bigint")
    return events(spark, sf_dir).select(
        "event_id",
        scalar.epoch_seconds_to_time(seconds).cast("timestamp_ntz").alias("t1"),
        scalar.epoch_text_to_time(seconds).cast("timestamp_ntz").alias("t2"),
    )


@query("fn_parse_ts", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def fn_parse_ts(spark, sf_dir):
    text = F.date_format("ts", readers.WEB_LOG_TIME)
    parsed = scalar.parse_time(text, readers.WEB_LOG_TIME).cast("timestamp_ntz")
    return events(spark, sf_dir).select("event_id", parsed.alias("parsed"))


@query("fn_format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events")
def fn_format_ts(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", scalar.format_time("ts").alias("shown"))


@query("fn_proctime", "SELECT event_type, count(*) AS n, true AS stamped FROM events GROUP BY 1")
def fn_proctime(spark, sf_dir):
    stamped = events(spark, sf_dir).withColumn("pt", scalar.processing_time())
    fresh = F.min(F.unix_seconds("pt")) > F.unix_timestamp(F.lit("2024-01-30"), "yyyy-MM-dd")
    return stamped.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), fresh.alias("stamped"))


@query("fn_next_midnight", """
    SELECT event_id, CAST(epoch(date_trunc('day', ts + INTERVAL 8 HOUR) + INTERVAL 1 DAY - INTERVAL 8 HOUR) AS BIGINT)
           AS midnight FROM events""")
def fn_next_midnight(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", scalar.next_midnight(_seconds("ts").cast("bigint"), "8 hours").alias("midnight")
    )


@query("fn_bit_offset", """
    SELECT p_partkey, CAST(list_reduce(list_prepend(CAST(0 AS HUGEINT),
             list_transform(string_split(right('0' || p_partkey, 6), ''), lambda c: CAST(ascii(c) AS HUGEINT))),
           lambda a, c: a * 32 + c) & 1073741823 AS BIGINT) AS bit FROM part""")
def fn_bit_offset(spark, sf_dir):
    text = F.concat(F.lit("0"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", scalar.bit_offset(text).alias("bit"))


# ------------------------------------------------------------- user-written functions

@query("udf_scalar", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n, CAST(length(lang) AS INTEGER) AS m FROM documents")
def udf_scalar(spark, sf_dir):
    udfs.register(spark)
    docs = table(spark, sf_dir, "documents")
    return spark.sql("SELECT doc_id, my_length(text) AS n, my_length(lang) AS m FROM {d}", d=docs)


SPLIT_SQL = "SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS word FROM part"


@query("udtf_split", SPLIT_SQL)
def udtf_split(spark, sf_dir):
    udfs.register(spark)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return spark.sql("SELECT t.p_partkey, t.p_name, s.word FROM {t} t, LATERAL split_words(t.p_name, ' ') s", t=parts)


@query("lateral_udtf", SPLIT_SQL)
def lateral_udtf(spark, sf_dir):
    from millrace.operators.joins import lateral_rows

    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lateral_rows(parts, lambda d: scalar.split_literal(d["p_name"], " "), "word")


@query("udaf_avg", "SELECT user_id, round(avg(value), 8) AS average FROM events GROUP BY 1")
def udaf_avg(spark, sf_dir):
    averages = udfs.udaf_avg(events(spark, sf_dir), ["user_id"], "value")
    return averages.withColumn("average", F.round("average", 8))


@query("udtaf_top2", """
    SELECT user_id, value, 'TOP' || r AS rank FROM (
      SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events)
    WHERE r <= 2""")
def udtaf_top2(spark, sf_dir):
    return udfs.udtaf_top2(events(spark, sf_dir).select("user_id", "value", "event_id"), ["user_id"], "value", "event_id")

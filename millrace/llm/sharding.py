"""Two-pass external shuffle: scatter into memory-sized buckets, then Fisher-Yates inside each.

Pass one sends every record to a bucket chosen by a seeded hash of its key and text. Rows that repeat both and would fill more
than a quarter of a bucket are numbered and dealt in blocks of that size, so buckets are uniform whatever the order, the source or
the copies of the input. Pass two shuffles each bucket in memory. The buckets in order, each in its
shuffled order, are one random permutation of the input; shard ``s`` of ``n`` takes its positions from
``ceil(s * rows / n)`` on, so shard sizes differ by one row at most.

Defined results: a null key is a key like any other; a null text counts no bytes; rows that repeat a key are told apart
by their text, and rows that repeat both are interchangeable; an empty table gives no rows; further columns of any name
travel inside the struct ``doc``. The same rows, seed and bucket count give the same result however they are partitioned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stored

MIN_BUCKETS = 64


def bucket_count(docs: DataFrame, text: str, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes``, from the size of all texts; at least ``MIN_BUCKETS`` so that small inputs spread too."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16).alias("n")).first()["n"] or 0
    return max(MIN_BUCKETS, -(-size // bucket_bytes))


def scatter(docs: DataFrame, n_buckets: int, seed: int, key: str, text: str, bucket_bytes: int) -> DataFrame:
    """Pass one: ``doc`` with its bucket and two hashes that fix an order inside the bucket."""
    name = ["by_key", "by_text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.xxhash64(F.lit(seed + 1), F.col(key)).alias("by_key"),
        F.xxhash64(F.lit(seed + 2), F.col(text)).alias("by_text"),
        F.greatest(F.lit(1), F.floor(F.lit(bucket_bytes // 4) / (F.coalesce(F.octet_length(text), F.lit(0)) + 16))).alias("block"),
    )
    dealt = lambda df, *more: df.select(
        "doc", F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in name], *more), F.lit(n_buckets)).alias("bucket"), *name)
    copies = rows.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("most")).where("n > most").select(*name)
    copies = stored(copies, "many-copies")
    if copies.isEmpty():
        return dealt(rows)
    # A number for each copy: those in earlier files, and a running number inside the file.
    many = stored(rows.join(copies, name, "left_semi"), "copies").withColumn("file", F.col("_metadata.file_name"))
    earlier = Window.partitionBy(*name).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = many.groupBy(*name, "file").agg(F.count(F.lit(1)).alias("n")).select(
        *name, "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy(*name, "file").orderBy("block")) - 1
    numbered = many.withColumn("nth", nth).join(offsets, [*name, "file"])
    blocks = dealt(numbered, F.floor((F.col("before") + F.col("nth")) / F.col("block")))
    return dealt(rows.join(copies, name, "left_anti")).unionByName(blocks)


def fisher_yates(seed: int):
    """Pass two, for one bucket: canonical order, then a seeded Fisher-Yates permutation."""

    def run(key, bucket):
        order = pc.sort_indices(bucket, sort_keys=[("by_key", "ascending"), ("by_text", "ascending")])
        places = np.arange(bucket.num_rows, dtype=np.int64)
        np.random.default_rng([seed, key[0].as_py()]).shuffle(places)  # numpy's shuffle is Fisher-Yates
        mixed = bucket.take(order).take(pa.array(places))
        return pa.table({
            "doc": mixed["doc"], "bucket": mixed["bucket"], "place": pa.array(np.arange(len(places), dtype=np.int64)),
        })

    return run


def shuffle_into_shards(
    docs: DataFrame, n_shards: int = 40, *, seed: int = 20, key: str = "doc_id", text: str = "text",
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """``doc``, ``shard`` and ``slot`` (from 0, without gaps) of every row."""
    n_buckets = bucket_count(docs, text, bucket_bytes)
    scattered = scatter(docs, n_buckets, seed, key, text, bucket_bytes)
    schema = T.StructType([
        T.StructField("doc", docs.schema), T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType()),
    ])
    placed = scattered.groupBy("bucket").applyInArrow(fisher_yates(seed), schema)
    # One row per bucket: where it begins, and how many rows there are in all.
    sizes = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("bucket").alias("of"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    joined = placed.join(starts, placed["bucket"] == starts["of"])
    at = joined.withColumn("position", F.col("start") + F.col("place"))
    shard = F.expr(f"cast(position * {n_shards} div total as int)")
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return at.withColumn("shard", shard).select("doc", "shard", (F.col("position") - first).alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """A folder per shard. A bucket spans few shards, so no further shuffle is needed; ``slot`` gives the order inside a shard."""
    shuffled.write.partitionBy("shard").parquet(path)

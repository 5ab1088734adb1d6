"""Grouped, running and distinct aggregation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pandas.core.groupby import SeriesGroupBy
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.operators import sequence as seq
from millrace.operators.sequence import sequence


def group_agg(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Final result per key.  Partial aggregation before the shuffle is built in."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def composite_key_count(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def concat_key_count(df: DataFrame, columns: list[str], key: str = "key", name: str = "n") -> DataFrame:
    """Count per key glued from several columns with an underscore."""
    # Grouping on the columns first keeps the shuffled key short; gluing is done once per group.
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    glued = groups.select(F.concat_ws("_", *columns).alias(key), name)
    return glued.groupBy(key).agg(F.sum(name).alias(name))


def pv_count(df: DataFrame, condition: Column, name: str = "pv") -> DataFrame:
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


# ------------------------------------------------------------------ running forms


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Sum so far after every row of a key."""
    return sequence(df, keys, order).running(**{name: seq.total(value)}).df


def running_max(
    df: DataFrame, keys: list[str], order: list[str], value: str, first_of: dict[str, str]
) -> DataFrame:
    """Maximum so far; ``first_of`` columns keep the key's first row's values."""
    firsts = {new: seq.earliest(F.struct(F.col(old).alias("v"))) for new, old in first_of.items()}
    rows = sequence(df, keys, order).running(**{f"max_{value}": seq.highest(value)}, **firsts).df
    return rows.withColumns({new: F.col(new)["v"] for new in first_of})


def running_max_by(
    df: DataFrame, keys: list[str], order: list[str], value: str, arrival: str, name: str = "best"
) -> DataFrame:
    """Whole row that holds the maximum so far; the latest row wins a tie."""
    others = [c for c in df.columns if c not in (value, arrival)]
    row = F.struct(value, arrival, *others)
    return sequence(df, keys, order).running(**{name: seq.highest(row)}).df


def running_reduce(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Fold that keeps the newest row's fields with the maximum so far."""
    return sequence(df, keys, order).running(**{name: seq.highest(value)}).df


def running_avg(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Average so far from a running (sum, count) pair."""
    has_value = F.col(value).isNotNull()
    rows = sequence(df, keys, order).running(_sum=seq.total(value), _count=seq.tally(has_value)).df
    return rows.withColumn(name, F.col("_sum") / F.col("_count")).drop("_sum", "_count")


def running_count(df: DataFrame, order: list[str], name: str = "nth", keys: list[str] | None = None) -> DataFrame:
    """Ordinal of each row, over the whole input or per key."""
    return sequence(df, keys or [], order).running(**{name: seq.tally()}).df


def running_distinct(df: DataFrame, value: str, arrival: str, name: str = "uv") -> DataFrame:
    """How many different values have been seen, after each row.

    The first arrival of each value comes from a partial aggregate, so a value
    with very many rows costs one row per task.  The marks go into the scan as
    extra rows right before the row they belong to; no join is needed.
    """
    firsts = df.groupBy(value).agg(F.min(arrival).alias(arrival)).where(F.col(value).isNotNull())
    marks = firsts.select(arrival, F.lit(1).cast("bigint").alias("_new"), F.lit(0).alias("_row"))
    rows = df.withColumns({"_new": F.lit(0).cast("bigint"), "_row": F.lit(1)})
    both = rows.unionByName(marks, allowMissingColumns=True)
    counted = sequence(both, [], [arrival, "_row"]).running(**{name: seq.total("_new")}).df
    return counted.where("_row = 1").drop("_new", "_row")


def distinct_values(df: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """First row of each key.  ``min_by`` keeps one row per key and task before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(arrival)).alias("_row"))
    return firsts.select(*keys, "_row.*")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key, again without a window."""
    others = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def keyed_profile(df: DataFrame, keys: list[str], order: list[str], value: str, keep: int = 3) -> DataFrame:
    """Running profile of a key: newest value, last ``keep`` values, count, sum, maximum, average."""
    rows = sequence(df, keys, order).running(
        last_value=seq.latest(value), n=seq.tally(), total=seq.total(value), highest=seq.highest(value)
    )
    rows = rows.bounded(
        keep - 1, recent=lambda w: F.collect_list(value).over(w.rowsBetween(-(keep - 1), 0))
    )
    return rows.df.withColumn("average", F.col("total") / F.col("n"))


# ---------------------------------------------------------------- skew and distinct


def salted_two_phase(
    df: DataFrame, keys: list[Column | str], salts: int = 8, name: str = "n", extra_salt: list[str] | None = None
) -> DataFrame:
    """Count in two steps over a salted key.

    The salt is a hash of the row, not a random number: a task that is run
    again after a lost executor produces the same groups.
    """
    salt = F.pmod(F.xxhash64(*(extra_salt or df.columns)), F.lit(salts))
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    partial = df.groupBy(*named, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    rest = [c for c in partial.columns if c not in ("_salt", "_n")]
    return partial.groupBy(*rest).agg(F.sum("_n").alias(name))


def exact_distinct(df: DataFrame, keys: list[Column | str], value: str, name: str = "uv") -> DataFrame:
    """Exact distinct count in two group-bys: one row per (key, value), then a count.

    The second step has counts to add, not sets, so one crowded window spreads
    over all tasks of the first step.
    """
    pairs = df.groupBy(*keys, value).agg(F.lit(1).alias("_one"))
    rest = [c for c in pairs.columns if c not in (value, "_one")]
    return pairs.groupBy(*rest).agg(F.count(value).alias(name))


def bitmap_distinct(df: DataFrame, keys: list[str], offset: Column, name: str = "uv") -> DataFrame:
    """Distinct count through bitmaps: one bit per offset, 32,768 bits per group row.

    Two values with the same offset count once, as in any one-hash bitmap.
    """
    # Bitmap buckets start at 1 and positions are taken inside the bucket.
    bits = df.select(*keys, offset.alias("_bit"))
    parts = bits.groupBy(*keys, F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_bit"))).alias("_set")
    )
    return parts.groupBy(*keys).agg(F.sum("_set").alias(name))


def approx_distinct(df: DataFrame, keys: list[str], value: str, rsd: float = 0.02, name: str = "uv") -> DataFrame:
    return df.groupBy(*keys).agg(F.approx_count_distinct(value, rsd).alias(name))


# ------------------------------------------------------------ user-written aggregates


def user_aggregate(
    df: DataFrame,
    keys: list[str],
    value: str,
    fields: dict[str, str],
    accumulate: Callable[[SeriesGroupBy], dict[str, pd.Series]],
    finish: Column,
    name: str,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """A Python accumulator that scales: accumulate per Arrow batch, merge on the JVM.

    ``accumulate`` gets a batch's values grouped by key and folds each group
    into ``fields``, one pandas series per field; each field names the built-in
    aggregate that merges it (sum, min, max).  A group is never handed to
    Python as a whole, so it may be of any size.  Keys and values keep their
    types, nulls included; ``types`` gives those of the fields, double if left out.
    """
    kinds = {f: (types or {}).get(f, "double") for f in fields}
    schema = ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys], *[f"`{f}` {t}" for f, t in kinds.items()]])
    field_types = {f.name: to_arrow_type(f.dataType) for f in T.StructType.fromDDL(", ".join(f"`{f}` {t}" for f, t in kinds.items()))}

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                # Arrow-backed columns: an integer key with nulls stays an integer.
                frame = batch.to_pandas(types_mapper=pd.ArrowDtype)
                parts = accumulate(frame.groupby(keys, dropna=False, sort=False)[value])
                folded = pd.DataFrame({f: parts[f] for f in fields}).reset_index()
                target = {**{k: batch.schema.field(k).type for k in keys}, **field_types}
                yield pa.RecordBatch.from_arrays([pa.Array.from_pandas(folded[c]).cast(t) for c, t in target.items()], list(target))

    merged = df.select(*keys, value).mapInArrow(partial, schema).groupBy(*keys).agg(
        *[getattr(F, how)(field).alias(field) for field, how in fields.items()]
    )
    return merged.select(*keys, finish.alias(name))


def changelog(
    df: DataFrame, keys: list[str], order: list[str], columns: dict[str, seq.Running]
) -> DataFrame:
    """A running aggregate as a change stream.

    After each row the key's old result is withdrawn (``is_insert`` false) and
    the new one inserted; a key's first row only inserts.
    """
    before = {f"_old_{n}": c.before() for n, c in columns.items()}
    rows = sequence(df, keys, order).running(_seen=seq.tally().before(), **columns, **before).df
    names = list(columns)
    old = F.struct(F.lit(False).alias("is_insert"), *[F.col(f"_old_{n}").alias(n) for n in names])
    new = F.struct(F.lit(True).alias("is_insert"), *names)
    pair = F.when(F.coalesce("_seen", F.lit(0)) > 0, F.array(old, new)).otherwise(F.array(new))
    return rows.select(*keys, *[o for o in order if o not in keys], F.explode(pair).alias("_c")).select(
        *keys, *[o for o in order if o not in keys], "_c.*"
    )



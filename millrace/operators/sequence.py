"""Ordered work per key that survives a hot key.

A running total, a ``lag`` or a row number is a window ordered by arrival.
Spark runs such a window in one task per key, which is right while every key
is small and hopeless once one key owns a third of the table.  ``sequence``
therefore measures the keys first:

* no key above the slice limit: ordinary windows, one shuffle on the key;
* otherwise the other keys still take that way, and the rows of the large keys
  are cut along the order axis into slices that fit one task.  Each slice is
  summarised with a normal aggregate, the summaries (one row per slice) are
  accumulated, and the accumulated value is put in front of the next slice as
  one extra *seam* row.  The same window expression then runs per (key, slice)
  and the seam rows are dropped.

With no key at all (a running total over a whole table) slices are always
used, so a table is never ordered inside a single partition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import stored

SLICE = "_slice"
DATA = "_is_data"
SLICE_ROWS_CONF = "millrace.rowsPerSlice"
SLICE_ROWS_DEFAULT = 4_000_000
# A helper table with more measured rows than this is joined by shuffle, not broadcast.
BROADCAST_ROWS = 100_000


def rows_per_slice(spark: SparkSession) -> int:
    return int(spark.conf.get(SLICE_ROWS_CONF, str(SLICE_ROWS_DEFAULT)))


def ticks(df: DataFrame, name: str) -> Column:
    """An order column as a bigint: microseconds for times, itself for integers."""
    return ticks_of(F.col(name), df.schema[name].dataType.typeName())


def ticks_of(column: Column, kind: str) -> Column:
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind != "timestamp_ntz":
        return column.cast("bigint")
    # From the clock fields, so that the session's time zone plays no part.
    minutes = (F.unix_date(F.to_date(column)).cast("bigint") * 24 + F.hour(column)) * 60 + F.minute(column)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


# ---------------------------------------------------------------- running values

_FOLDS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
}


@dataclass(frozen=True)
class Running:
    """One running column: ``value`` folded over the rows so far."""

    fold: str
    value: Column
    with_current: bool = True
    boxed: bool = False

    def before(self) -> Running:
        """The same value over the earlier rows only."""
        return replace(self, with_current=False)

    def merge(self, column: str) -> Column:
        return _FOLDS[self.fold](F.col(column))

    def summary(self, column: str, order: tuple[str, ...], descending: bool) -> Column:
        """The fold of one whole slice as a plain aggregate."""
        if self.fold not in ("first", "last"):
            return self.merge(column)
        place = F.when(F.col(column).isNotNull(), F.struct(*order))
        newest = (self.fold == "last") != descending
        return (F.max_by if newest else F.min_by)(F.col(column), place)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: Column | str) -> Running:
    return Running("sum", _col(value))


def tally(condition: Column | None = None) -> Running:
    """How many rows, or how many rows satisfy ``condition``."""
    hit = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
    return Running("sum", hit.cast("bigint"))


def highest(value: Column | str) -> Running:
    return Running("max", _col(value))


def lowest(value: Column | str) -> Running:
    return Running("min", _col(value))


def latest(value: Column | str) -> Running:
    """Newest non-null value."""
    return Running("last", _col(value))


def earliest(value: Column | str) -> Running:
    """Oldest non-null value."""
    return Running("first", _col(value))


def previous(value: Column | str) -> Running:
    """Value of the row directly before, null or not."""
    return Running("last", F.struct(_col(value).alias("v")), with_current=False, boxed=True)


# ---------------------------------------------------------------------- sequence


@dataclass(frozen=True)
class Part:
    """Keys that are handled alike: whole, or cut into slices."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    descending: bool
    sliced: bool
    scanned: bool = False

    def running(self, peers: bool, columns: dict[str, Running]) -> Part:
        part = self._settled()
        fed = part.rows.select("*", *[c.value.alias(_fed(n)) for n, c in columns.items()])
        if self.sliced:
            fed = fed.withColumn(DATA, F.lit(1))
            fed = fed.unionByName(self._seams(fed, columns), allowMissingColumns=True)
        spec = self._window(DATA) if self.sliced else self._window()
        upto = spec if peers else spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ahead = spec.rowsBetween(Window.unboundedPreceding, -1)
        added = {}
        for name, item in columns.items():
            value = item.merge(_fed(name)).over(upto if item.with_current else ahead)
            added[name] = value["v"] if item.boxed else value
        return self._data_only(fed.withColumns(added).drop(*[_fed(n) for n in columns]))

    def bounded(self, preceding: int, columns: dict[str, Callable[[WindowSpec], Column]]) -> Part:
        rows = self._settled().rows
        if self.sliced:
            rows = rows.withColumn(DATA, F.lit(1))
            rows = rows.unionByName(self._halo(rows, preceding))
        spec = self._window()
        return self._data_only(rows.withColumns({n: make(spec) for n, make in columns.items()}))

    # -- helpers

    def _settled(self) -> Part:
        """A sliced scan reads its input twice, so the result of an earlier scan is stored first."""
        if self.sliced and self.scanned:
            return replace(self, rows=stored(self.rows, "slices"), scanned=False)
        return self

    def _direction(self, name: str) -> Column:
        return F.col(name).desc() if self.descending else F.col(name).asc()

    def _window(self, *lead: str) -> WindowSpec:
        parts = [*self.keys, SLICE] if self.sliced else list(self.keys)
        return Window.partitionBy(*parts).orderBy(*lead, *map(self._direction, self.order))

    def _across_slices(self) -> WindowSpec:
        """The slices of one key in order, one summary row each."""
        return Window.partitionBy(*self.keys).orderBy(self._direction(SLICE))

    def _data_only(self, rows: DataFrame) -> Part:
        if self.sliced:
            rows = rows.where(F.col(DATA) == 1).drop(DATA)
        return replace(self, rows=rows, scanned=True)

    def _seams(self, fed: DataFrame, columns: dict[str, Running]) -> DataFrame:
        """One row per (key, slice): everything folded from the slices before it."""
        across = self._across_slices()
        ahead = across.rowsBetween(Window.unboundedPreceding, -1)
        per_slice = fed.groupBy(*self.keys, SLICE).agg(
            *[c.summary(_fed(n), self.order, self.descending).alias(_fed(n)) for n, c in columns.items()]
        )
        carried = per_slice.select(
            *self.keys,
            SLICE,
            F.row_number().over(across).alias("_nth"),
            *[c.merge(_fed(n)).over(ahead).alias(_fed(n)) for n, c in columns.items()],
            F.lit(0).alias(DATA),
        )
        return carried.where("_nth > 1").drop("_nth")

    def _halo(self, rows: DataFrame, preceding: int) -> DataFrame:
        """The ``preceding`` rows before each slice, copied into it."""
        newest_first = Window.partitionBy(*self.keys, SLICE).orderBy(
            *[F.col(c).asc() if self.descending else F.col(c).desc() for c in self.order]
        )
        fields = [c for c in rows.columns if c not in (*self.keys, SLICE, DATA)]
        row = F.struct(F.struct(*self.order).alias("place"), F.struct(*fields).alias("row"))
        tails = (
            rows.withColumn("_r", F.row_number().over(newest_first))
            .where(F.col("_r") <= preceding)
            .groupBy(*self.keys, SLICE)
            .agg(F.collect_list(row).alias("_tail"))
        )
        # A slice holds at least one row, so `preceding` earlier slices are enough.
        near = self._across_slices().rowsBetween(-preceding, -1)
        ranked = F.sort_array(F.flatten(F.collect_list("_tail").over(near)), asc=self.descending)
        return (
            tails.select(*self.keys, SLICE, F.slice(ranked, 1, preceding).alias("_near"))
            .select(*self.keys, SLICE, F.explode("_near").alias("_h"))
            .select(*self.keys, SLICE, "_h.row.*", F.lit(0).alias(DATA))
        )


@dataclass(frozen=True)
class Sequence:
    """Rows of each key in a fixed order; see the module text."""

    parts: tuple[Part, ...]

    @property
    def df(self) -> DataFrame:
        frames = [p.rows.drop(SLICE) for p in self.parts]
        return reduce(DataFrame.unionByName, frames)

    @property
    def sliced(self) -> bool:
        return any(p.sliced for p in self.parts)

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> Sequence:
        """Apply a row-wise change (added columns, a filter) and keep the slices."""
        return self._each(lambda p: replace(p, rows=change(p.rows)))

    def reversed(self) -> Sequence:
        """The same slices walked from the newest row to the oldest."""
        return self._each(lambda p: replace(p, descending=not p.descending))

    def running(self, peers: bool = False, **columns: Running) -> Sequence:
        """Add running columns over all earlier rows and the current one.

        With ``peers`` rows of equal order value see one another (RANGE frame).
        """
        return self._each(lambda p: p.running(peers, columns))

    def bounded(self, preceding: int, **columns: Callable[[WindowSpec], Column]) -> Sequence:
        """Add columns that look back at most ``preceding`` rows.

        Each function gets the ordered window and returns a window expression,
        such as ``lambda w: F.sum("v").over(w.rowsBetween(-2, 0))``.
        """
        return self._each(lambda p: p.bounded(preceding, columns))

    def _each(self, step: Callable[[Part], Part]) -> Sequence:
        return Sequence(tuple(step(p) for p in self.parts))


def _fed(name: str) -> str:
    return f"_fed_{name}"


def sequence(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    descending: bool = False,
    limit: int | None = None,
) -> Sequence:
    """Order the rows of each key by ``order``; slice the keys above ``limit`` rows.

    ``order`` must be a total order per key (end it with the arrival column).
    Its first column, an integer or a time, is the axis that slices are cut on.
    """
    limit = limit or rows_per_slice(df.sparkSession)
    whole, cut = (None, _slice_whole(df, order, limit)) if not keys else _split_keys(df, keys, order, limit)
    parts = [
        Part(rows, tuple(keys), tuple(order), descending, sliced)
        for rows, sliced in ((whole, False), (cut, True))
        if rows is not None
    ]
    return Sequence(tuple(parts))


def _step(rows: Column, span: Column, limit: int, factor: int) -> Column:
    """Slice width on the order axis; rows bunched on the axis need a larger factor."""
    pieces = F.ceil(rows / F.lit(limit)) * factor
    return F.greatest(F.ceil(span / pieces), F.lit(1)).cast("bigint")


def _slice_whole(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    axis = ticks(df, order[0])
    n, lo, hi = df.agg(F.count(F.lit(1)), F.min(axis), F.max(axis)).first()
    if not n or lo is None:  # no rows, or no order value: one slice
        return df.withColumn(SLICE, F.lit(0).cast("bigint"))
    spread = max(1, df.sparkSession.sparkContext.defaultParallelism)
    limit = max(1, min(limit, -(-n // spread)))
    factor = 4
    while True:
        step = max(1, -(-(hi - lo + 1) // (-(-n // limit) * factor)))
        cut = F.floor((axis - F.lit(lo)) / F.lit(step)).cast("bigint")
        if step == 1 or n <= 100_000:
            break
        fullest = df.groupBy(cut.alias("c")).count().agg(F.max("count")).first()[0]
        if fullest <= limit:
            break
        factor *= 8
    return df.withColumn(SLICE, F.coalesce(cut, F.lit(-1)))


def _split_keys(
    df: DataFrame, keys: list[str], order: list[str], limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys as they are, and those of large keys with a slice number."""
    axis = ticks(df, order[0])
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(axis).alias("_lo"), F.max(axis).alias("_hi")
    )
    hot = sizes.where(F.col("_n") > limit)
    n_hot = hot.count()
    if not n_hot:
        return df, None
    # A few rows, used by every later step: kept, so that the table is counted no more than twice.
    hot = stored(hot, "hot-keys")
    factor = 4
    while True:
        grid = hot.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            "_lo",
            _step(F.col("_n"), F.col("_hi") - F.col("_lo") + 1, limit, factor).alias("_step"),
        )
        if n_hot <= BROADCAST_ROWS:
            grid = F.broadcast(grid)
        same_key = reduce(and_, [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        cut = F.floor((axis - F.col("_lo")) / F.col("_step")).cast("bigint")
        fullest, widest = (
            df.join(grid, same_key)
            .groupBy(*keys, cut.alias("c"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("_step").alias("s"))
            .agg(F.max("n"), F.max("s"))
            .first()
        )
        if fullest <= limit or (widest or 0) <= 1:
            break
        factor *= 8
    helpers = ["_lo", "_step", *[f"_k{i}" for i in range(len(keys))]]
    large = df.join(grid, same_key).withColumn(SLICE, F.coalesce(cut, F.lit(-1))).drop(*helpers)
    return df.join(grid, same_key, "left_anti"), large

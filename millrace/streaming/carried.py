"""Keyed state between micro-batches as tables, worked on by the batch operators.

A micro-batch is a table, so the ordered operators of ``operators.sequence`` run on it as they are: on the JVM, with hot keys cut
over several tasks. What a key needs from earlier batches goes in front of its rows as a few *carried* rows: the values accumulated so
far, the last rows, the open begins. The operator sees one unbroken history, and its answers for carried rows are dropped.

``KeyedRows`` keeps the carried rows. A batch writes those of the keys it touched, in a folder of its own, so a batch that is repeated
after a failure overwrites only what it wrote itself. Every ``SNAPSHOT`` batches the whole state is written once, without keys that carry
nothing or have expired, so reading touches one snapshot and fewer than ``SNAPSHOT`` small folders, however old the stream is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import micros
from millrace.operators import alerts, joins, patterns, topn
from millrace.operators import sequence as seq
from millrace.operators.project import tagged_union
from millrace.operators.sequence import Running, sequence, ticks
from millrace.operators.watermark import span
from millrace.session import scratch
from millrace.streaming.runtime import run_batches

SNAPSHOT = 8
ROW = "_row"  # 1: a row of the batch, 0: a carried one
VERSION = "_version"


def _others(right: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """The right side of a join on keys that may be null, under names of its own, and the condition."""
    renamed = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    return renamed, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


class KeyedRows:
    """Any number of carried rows per key; the newest batch that touched a key decides.

    ``ttl`` is a column and a duration: keys whose value lies further behind the newest one leave with the next snapshot.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], ttl: tuple[str, str] | None = None):
        self.spark, self.path, self.keys, self.ttl = spark, path, keys, ttl
        self.schema: T.StructType | None = None  # known once a batch was written, which saves a job per read

    def _versions(self, batch_id: int) -> DataFrame | None:
        """One snapshot and the folders after it."""
        if batch_id == 0:
            return None
        whole = batch_id // SNAPSHOT * SNAPSHOT - 1  # the last batch that wrote a snapshot
        paths = [f"{self.path}/whole-{whole}"] if whole >= 0 else []
        paths += [f"{self.path}/part-{n}" for n in range(whole + 1, batch_id)]
        return self._read(*paths)

    def _read(self, *paths: str) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(self.schema) if self.schema else reader).parquet(*paths)

    def _newest(self, versions: DataFrame, touched: DataFrame | None = None) -> DataFrame:
        last = versions.groupBy(*self.keys).agg(F.max(VERSION).alias("_last"))
        if touched is not None:  # told from keys alone, so that the rows themselves are joined once
            last = last.join(*_others(touched, self.keys), "left_semi")
        last, same = _others(last, self.keys)
        newest = versions.join(last, same & (F.col(VERSION) == F.col("_last"))).where("_carries")
        return newest.select(*[c for c in versions.columns if c not in ("_carries", VERSION)])

    def before(self, batch_id: int, touched: DataFrame | None = None) -> DataFrame | None:
        """Rows carried into a batch, of the touched keys or of all; none at the start."""
        versions = self._versions(batch_id)
        return None if versions is None else self._newest(versions, touched)

    def leave(self, rows: DataFrame, touched: DataFrame, batch_id: int) -> None:
        """``rows`` replace whatever the ``touched`` keys carried."""
        marks = touched.select(*self.keys).distinct().withColumn("_carries", F.lit(False))
        both = rows.withColumn("_carries", F.lit(True)).unionByName(marks, allowMissingColumns=True)
        both = both.withColumn(VERSION, F.lit(batch_id).cast("long"))
        both.write.mode("overwrite").parquet(f"{self.path}/part-{batch_id}")
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in both.schema])
        if (batch_id + 1) % SNAPSHOT == 0:
            whole = self._newest(self._versions_with(batch_id))
            if self.ttl:
                column, keep = self.ttl
                newest = whole.agg(F.max(column).alias("_newest"))  # one row
                whole = whole.crossJoin(F.broadcast(newest)).where(F.col(column) >= F.col("_newest") - span(keep)).drop("_newest")
            kept = whole.withColumns({"_carries": F.lit(True), VERSION: F.lit(batch_id).cast("long")})
            kept.write.mode("overwrite").parquet(f"{self.path}/whole-{batch_id}")

    def _versions_with(self, batch_id: int) -> DataFrame:
        mine = self._read(f"{self.path}/part-{batch_id}")
        earlier = self._versions(batch_id)
        return mine if earlier is None else earlier.unionByName(mine, allowMissingColumns=True)


class WholeRows:
    """Carried rows of no key, or few enough that each batch writes them all: the folder of the batch before holds everything."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema: T.StructType | None = None

    def before(self, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        return (self.spark.read.schema(self.schema) if self.schema else self.spark.read).parquet(f"{self.path}/{batch_id - 1}")

    def leave(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])


class Hold:
    """Frames that a step uses more than once, cached until its batch is done."""

    def __init__(self):
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.frames.append(df.persist())
        return self.frames[-1]

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()


@dataclass(frozen=True)
class Output:
    """Where the batches of a query write: a folder per name and batch id."""

    spark: SparkSession
    base: str

    def store(self, rows: DataFrame, batch_id: int, name: str = "rows") -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/{name}/batch_id={batch_id}")

    def read(self, name: str = "rows") -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}").drop("batch_id")


def _in_front(batch: DataFrame, carried: DataFrame | None) -> DataFrame:
    rows = batch.withColumn(ROW, F.lit(1))
    return rows if carried is None else rows.unionByName(carried.withColumn(ROW, F.lit(0)), allowMissingColumns=True)


def by_batches(stream: DataFrame, label: str, make: Callable[[SparkSession, str, Hold], Callable[[DataFrame, int], DataFrame]]) -> DataFrame:
    """Run a step over all micro-batches and read back what it gave. The batch is cached while it is worked on."""
    spark = stream.sparkSession
    out, hold = Output(spark, scratch(spark, label)), Hold()
    step = make(spark, out.base, hold)

    def each(batch: DataFrame, batch_id: int) -> None:
        try:
            out.store(step(hold(batch), batch_id), batch_id)
        finally:
            hold.release()

    run_batches(stream, each, out.base)
    return out.read()


# ------------------------------------------------------------------------ running values

def _value(name: str) -> str:
    return f"_v_{name}"


class RunningState:
    """Running columns per key. Carried: one row per key that holds the values so far, ordered before all others."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], columns: dict[str, Running],
                 peers: bool = False, ttl: tuple[str, str] | None = None):
        self.keys, self.order, self.columns, self.peers = keys, order, columns, peers
        self.state = KeyedRows(spark, path, keys, ttl)

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        fed = batch.select("*", *[c.value.alias(_value(n)) for n, c in self.columns.items()])
        touched = batch.select(*self.keys).distinct()
        rows = _in_front(fed, self.state.before(batch_id, touched))
        names = {n: replace(c, value=F.col(_value(n))) for n, c in self.columns.items()}
        upto = rows.groupBy(*self.keys).agg(
            *[c.summary(_value(n), tuple(self.order), False).alias(_value(n)) for n, c in names.items()])
        self.state.leave(upto, touched, batch_id)
        done = sequence(rows, self.keys, self.order).running(peers=self.peers, **names).df
        return done.where(F.col(ROW) == 1).drop(ROW, *[_value(n) for n in names])


def running(stream: DataFrame, keys: list[str], arrival: str, label: str, ttl: tuple[str, str] | None = None,
            **columns: Running) -> DataFrame:
    """Every row of a stream with running columns of its key, in arrival order."""
    return by_batches(stream, label, lambda spark, base, hold: RunningState(spark, f"{base}/state", keys, [arrival], columns, ttl=ttl).step)


def changelog(stream: DataFrame, keys: list[str], arrival: str, columns: dict[str, Running], label: str = "changelog") -> DataFrame:
    """A running aggregate as withdrawals (``is_insert`` false) and insertions."""
    before = {f"_old_{n}": c.before() for n, c in columns.items()}
    rows = running(stream, keys, arrival, label, _seen=seq.tally().before(), **columns, **before)
    names = list(columns)
    old = F.struct(F.lit(False).alias("is_insert"), *[F.col(f"_old_{n}").alias(n) for n in names])
    new = F.struct(F.lit(True).alias("is_insert"), *names)
    pair = F.when(F.coalesce("_seen", F.lit(0)) > 0, F.array(old, new)).otherwise(F.array(new))
    return rows.select(*keys, arrival, F.explode(pair).alias("_c")).select(*keys, arrival, "_c.*")


# --------------------------------------------------------------------------- recent rows

class RecentState:
    """Columns that look back at most ``preceding`` rows. Carried: those rows."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], preceding: int, columns: dict):
        self.keys, self.order, self.preceding, self.columns = keys, order, preceding, columns
        self.state = KeyedRows(spark, path, keys)

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        touched = batch.select(*self.keys).distinct()
        rows = _in_front(batch, self.state.before(batch_id, touched))
        last = [F.col(c).desc() for c in self.order]
        # Spark cuts to the first rows of each key inside every task, before the shuffle.
        self.state.leave(topn.top_n(rows.drop(ROW), self.keys, last, self.preceding, "_nth").drop("_nth"), touched, batch_id)
        done = sequence(rows, self.keys, self.order).bounded(self.preceding, **self.columns).df
        return done.where(F.col(ROW) == 1).drop(ROW)


def sliding_rows(stream: DataFrame, keys: list[str], arrival: str, size: int, label: str, **columns) -> DataFrame:
    """Every row with its number ``nth`` in its key and columns over the last ``size`` rows of it."""

    def make(spark, base, hold):
        count = RunningState(spark, f"{base}/count", keys, [arrival], {"nth": seq.tally()})
        recent = RecentState(spark, f"{base}/recent", keys, [arrival], size - 1, columns)
        return lambda batch, n: recent.step(count.step(batch, n), n)

    return by_batches(stream, label, make)


def running_top(stream: DataFrame, keys: list[str], arrival: str, value: str, n: int, label: str = "top") -> DataFrame:
    """After each row the key's ``n`` highest values so far. Carried: the rows that hold them."""

    def make(spark, base, hold):
        state = KeyedRows(spark, f"{base}/state", keys)

        def step(batch, batch_id):
            touched = batch.select(*keys).distinct()
            rows = _in_front(batch, state.before(batch_id, touched))
            best = [F.col(value).desc_nulls_last(), F.col(arrival)]
            state.leave(topn.top_n(rows.drop(ROW), keys, best, n, "_nth").drop("_nth"), touched, batch_id)
            return topn.running_top(rows, keys, [arrival], value, n).where(F.col(ROW) == 1).drop(ROW)

        return step

    return by_batches(stream, label, make)


# ---------------------------------------------------------------------- pairs and control

def match_pairs(both: DataFrame, key: str, arrival: str, side: str = "side", label: str = "match") -> DataFrame:
    """Pair the rows of two tagged inputs (``l`` and ``r``) one to one, first come first served. Carried: the rows without a partner.

    Rows of earlier batches came first; inside a batch the arrival column decides, then the side.
    """

    def make(spark, base, hold):
        state = KeyedRows(spark, f"{base}/state", [key])

        def step(batch, batch_id):
            # Rows without a key pair with nothing and are not carried.
            keyed = batch.where(F.col(key).isNotNull())
            touched = keyed.select(key).distinct()
            carried = state.before(batch_id, touched)
            # Cached, as the keys are counted before they are walked.
            rows = _in_front(keyed.withColumn("_came", F.lit(batch_id)), carried and hold(carried)).drop(ROW)
            # Both sides are numbered in one walk, and its partitioning serves the pairing.
            counts = {f"_n{s}": seq.tally(F.col(side) == s) for s in "lr"}
            numbered = sequence(rows, [key], ["_came", arrival, side]).running(**counts).df
            place = F.struct("_came", arrival, side)
            nth = F.when(F.col(side) == "l", F.col("_nl")).otherwise(F.col("_nr")).alias("_nth")
            # Keys and numbers meet in one group-by of at most two rows.
            pair = lambda s: F.max(F.when(F.col(side) == s, place))
            met = numbered.groupBy(key, nth).agg(pair("l").alias("l"), pair("r").alias("r"))
            met = hold(met)
            alone = met.where("l is null or r is null").select(key, F.coalesce("l", "r").alias("p")).select(key, "p.*")
            state.leave(alone, touched, batch_id)
            by = F.when(F.col("l") > F.col("r"), "left").otherwise("right")
            return met.where("l is not null and r is not null").select(
                key, F.col(f"l.{arrival}").alias(f"left_{arrival}"), F.col(f"r.{arrival}").alias(f"right_{arrival}"), by.alias("completed_by"))

        return step

    return by_batches(both, label, make)


def label_by_control(both: DataFrame, arrival: str, control: Column, value: Column, name: str, label: str = "control") -> DataFrame:
    """Data rows with the newest control value before them. Both inputs are streams, in one tagged union: ``control`` tells
    which rows are control rows, ``value`` what they say. Carried: the newest control row.
    """

    def make(spark, base, hold):
        state = WholeRows(spark, f"{base}/state")

        def step(batch, batch_id):
            rows = batch.withColumns({"_control": control, "_switch": F.when(control, F.struct(value.alias("v")))})
            newest = rows.where("_control").select(arrival, "_control", "_switch")
            carried = state.before(batch_id)
            seen = newest if carried is None else newest.unionByName(carried)
            last = seen.agg(F.max_by(F.struct(arrival, "_control", "_switch"), F.col(arrival)).alias("r")).where("r is not null")
            state.leave(last.select("r.*"), batch_id)
            told = sequence(_in_front(rows, carried), [], [arrival]).running(_newest=seq.latest("_switch")).df
            return told.where((F.col(ROW) == 1) & ~F.col("_control")).withColumn(name, F.col("_newest.v")).drop(
                ROW, "_control", "_switch", "_newest")

        return step

    return by_batches(both, label, make)


# ------------------------------------------------------------------ joins by key and time

def joined(left: DataFrame, right: DataFrame, key: str, times: tuple[str, str], delays: tuple[str, str], bounds: tuple[str, str],
           join: Callable[[DataFrame, DataFrame], DataFrame], label: str, outer: str = "", prefix: str = "") -> DataFrame:
    """A join of two streams by key and time; ``join`` is a batch operator of ``operators.joins``, called on the rows of each micro-batch.

    The right time lies within ``bounds`` of the left one. ``outer`` names the sides (``l``, ``r``) whose unmatched rows are told;
    ``prefix`` is what the operator puts before the names of right columns. Carried: the rows that rows still to come may meet, by the
    smaller watermark of the two inputs, and whether they met one. A pair is told in the batch of its later row, an unmatched row when
    nothing can meet it any more, or at once if it has no key or time. Late rows meet what is still carried. What is carried is looked
    for among the rows in its reach only, so a micro-batch shuffles its rows once, for the join.
    """
    columns, reach = {"l": left.columns, "r": right.columns}, {"l": joins.signed(bounds[1]), "r": -joins.signed(bounds[0])}
    sides = {"l": ("r", *times, *bounds), "r": ("l", *reversed(times), joins.negated(bounds[1]), joins.negated(bounds[0]))}

    def make(spark, base, hold):
        state = WholeRows(spark, f"{base}/state")
        marks = Marks(spark, f"{base}/marks", [micros(d) for d in delays])

        def step(batch, batch_id):
            newest = [F.max(F.when(F.col("side") == s, ticks(batch, time))) for s, time in zip("lr", times, strict=True)]
            passed = marks.advance(list(batch.agg(*newest).first()), batch_id)
            mark = F.lit(-(2**62) if None in passed else min(passed))
            carried = state.before(batch_id)
            rows = _in_front(batch.withColumn("_hit", F.lit(False)), carried and hold(carried))

            def of(side):
                at = ticks(rows, sides[side][1])
                gone = F.col(key).isNull() | at.isNull() | (at + F.lit(reach[side]) <= mark)
                return rows.where(F.col("side") == side).select(
                    *columns[side], (F.col(ROW) == 1).alias(f"_{side}_new"), F.col("_hit").alias(f"_{side}_hit"), gone.alias(f"_{side}_gone"))

            mine = {side: of(side) for side in "lr"}
            kept = []
            for side, (other, time, other_time, lower, upper) in sides.items():
                stay = mine[side].where(~F.col(f"_{side}_gone"))
                if side in outer:
                    # Rows that stay lie above the mark less their reach, and what meets them no further below that than the lower bound.
                    near = mine[other].where(ticks(mine[other], other_time) > mark - F.lit(reach[side]) + F.lit(joins.signed(lower)))
                    stay = joins.in_reach(stay, near, key, time, other_time, lower, upper, "both")
                    stay = stay.withColumn(f"_{side}_hit", F.col(f"_{side}_hit") | F.col("_met"))
                kept.append(stay.select(*columns[side], F.col(f"_{side}_hit").alias("_hit"), F.lit(side).alias("side")))
            state.leave(kept[0].unionByName(kept[1], allowMissingColumns=True), batch_id)

            found = join(mine["l"], mine["r"])
            names = {s: [f"{prefix if s == 'r' else ''}_{s}_{n}" for n in ("new", "hit", "gone")] for s in "lr"}
            (l_new, l_hit, l_gone), (r_new, r_hit, r_gone) = ([F.col(n) for n in names[s]] for s in "lr")
            told = F.when(l_new.isNotNull() & r_new.isNotNull(), l_new | r_new).when(l_new.isNotNull(), ~l_hit & l_gone).otherwise(
                ~r_hit & r_gone)
            return found.where(told).drop(*names["l"], *names["r"])

        return step

    return by_batches(tagged_union(left, right), label, make)


# ------------------------------------------------------------------------ event-time order

class Marks:
    """Watermarks of one or more inputs: the largest time seen less the delay of the input, in microseconds; a row for each batch."""

    def __init__(self, spark: SparkSession, path: str, delays: list[int]):
        self.spark, self.path, self.delays = spark, path, delays
        self.known: dict[int, list[int | None]] = {-1: [None] * len(delays)}

    def after(self, batch_id: int) -> list[int | None]:
        """The watermarks after a batch; none before the first time of an input."""
        if batch_id not in self.known:  # after a restart
            columns = ", ".join(f"m{i} long" for i in range(len(self.delays)))
            self.known[batch_id] = list(self.spark.read.schema(columns).parquet(f"{self.path}/{batch_id}").first())
        return self.known[batch_id]

    def advance(self, newest: list[int | None], batch_id: int) -> list[int | None]:
        """The watermarks after a batch with these largest times."""
        seen = [None if at is None else at - delay for at, delay in zip(newest, self.delays, strict=True)]
        new = [max((m for m in pair if m is not None), default=None) for pair in zip(self.after(batch_id - 1), seen, strict=True)]
        self.known = {batch_id - 1: self.after(batch_id - 1), batch_id: new}
        row = self.spark.range(1).coalesce(1).select(*[F.lit(m).cast("long").alias(f"m{i}") for i, m in enumerate(new)])
        row.write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        return new


class EventOrder:
    """Releases rows in event-time order: a row waits until the watermark of its own stream has passed it.

    The watermark is the largest time seen minus ``delay``, renewed per batch. Rows that it had passed before they came are late; they
    are kept apart (``late``). Waiting rows lie within the delay; their table is written anew per batch.
    """

    def __init__(self, spark: SparkSession, base: str, time: str, delay: str):
        self.spark, self.base, self.time = spark, base, time
        self.marks = Marks(spark, f"{base}/marks", [micros(delay)])

    def mark(self, batch_id: int) -> int | None:
        """The watermark after a batch in microseconds; none before the first time."""
        return self.marks.after(batch_id)[0]

    def advance(self, batch: DataFrame, batch_id: int) -> int | None:
        return self.marks.advance([batch.agg(F.max(ticks(batch, self.time))).first()[0]], batch_id)[0]

    def release(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, int | None]:
        """The rows that may be worked on now, and the watermark."""
        old, new = self.mark(batch_id - 1), self.advance(batch, batch_id)
        known = batch.where(F.col(self.time).isNotNull()).withColumn("_at", ticks(batch, self.time))
        late = F.lit(False) if old is None else F.col("_at") <= F.lit(old)
        known = known.withColumn("_late", late)
        if batch_id:
            known = known.unionByName(self._held(known.schema, batch_id - 1).where("not _late"))
        limit = F.lit(new if new is not None else -(2**63)).cast("long")
        known.where(F.col("_late") | (F.col("_at") > limit)).write.mode("overwrite").parquet(f"{self.base}/held/{batch_id}")
        return known.where(~F.col("_late") & (F.col("_at") <= limit)).drop("_at", "_late"), new

    def _held(self, schema: T.StructType, *batches: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/held/{n}" for n in batches])

    def late(self, schema: T.StructType, upto: int) -> DataFrame:
        """All rows that came too late, of the batches up to one."""
        full = T.StructType([*schema.fields, T.StructField("_late", T.BooleanType())])
        return self._held(full, *range(upto + 1)).where("_late").drop("_late")


def in_event_order(stream: DataFrame, time: str, delay: str, label: str, make: Callable) -> DataFrame:
    """Run a step over the rows of a stream in event-time order; the step also gets the batch id and the watermark."""

    def both(spark, base, hold):
        order = EventOrder(spark, base, time, delay)
        step = make(spark, f"{base}/state", hold)

        def each(batch, batch_id):
            ready, mark = order.release(batch, batch_id)
            return step(hold(ready), batch_id, mark if mark is not None else -(2**62))

        return each

    return by_batches(stream, label, both)


def over_unbounded(stream: DataFrame, keys: list[str], time: str, delay: str, label: str = "over", **columns: Running) -> DataFrame:
    """Running columns in event-time order; rows of one time see one another and leave together."""

    def make(spark, path, hold):
        state = RunningState(spark, path, keys, [time], columns, peers=True)
        return lambda ready, n, mark: state.step(ready, n)

    return in_event_order(stream, time, delay, label, make)


def consecutive(stream: DataFrame, keys: list[str], time: str, arrival: str, delay: str, condition: Column, times: int, within: str,
                label: str = "consecutive") -> DataFrame:
    """``pattern_consecutive`` on a stream. Carried: the last rows of each key."""

    def make(spark, path, hold):
        state = KeyedRows(spark, path, keys)

        def step(ready, batch_id, mark):
            touched = ready.select(*keys).distinct()
            rows = _in_front(ready, state.before(batch_id, touched))
            last = [F.col(time).desc(), F.col(arrival).desc()]
            state.leave(topn.top_n(rows.drop(ROW), keys, last, times - 1, "_nth").drop("_nth"), touched, batch_id)
            found = patterns.pattern_consecutive(rows, keys, time, arrival, condition, times, within)
            return found.where(F.col(ROW) == 1).drop(ROW)

        return step

    return in_event_order(stream, time, delay, label, make)


def followed_by(stream: DataFrame, keys: list[str], time: str, arrival: str, delay: str, begin: Column, then: Column, within: str,
                label: str = "followed") -> DataFrame:
    """``pattern_followed_by`` on a stream. Carried: the begins that still wait, none longer than ``within``."""

    def make(spark, path, hold):
        state = WholeRows(spark, path)

        def step(ready, batch_id, mark):
            marked = ready.select(*keys, time, arrival, begin.alias("_b"), then.alias("_t"))
            carried = state.before(batch_id)
            rows = _in_front(marked, carried).drop(ROW)
            found = patterns.pattern_followed_by(rows, keys, time, arrival, F.col("_b"), F.col("_t"), within)
            found = hold(found)
            ended = ticks(found, "timeout_time") - 1 <= F.lit(mark)  # an answer at the end of the wait is too late
            open_ones = found.where((F.col("kind") == "timeout") & ~ended)
            # A begin that is also an answer has answered when it came.
            waits = open_ones.select(*keys, F.col("begin_time").alias(time), F.col(f"begin_{arrival}").alias(arrival),
                                     F.lit(True).alias("_b"), F.lit(False).alias("_t"))
            state.leave(waits, batch_id)
            return found.where((F.col("kind") == "matched") | ended)

        return step

    return in_event_order(stream, time, delay, label, make)


def order_pay(stream: DataFrame, key: str, time: str, arrival: str, delay: str, create: Column, pay: Column, within: str,
              label: str = "order-pay") -> DataFrame:
    """``order_pay_monitor`` on a stream. Carried: the creates whose span has not ended."""
    width = micros(within)

    def make(spark, path, hold):
        state = WholeRows(spark, path)

        def step(ready, batch_id, mark):
            marked = ready.where(create | pay).select(key, time, arrival, create.alias("_c"), pay.alias("_p"))
            carried = state.before(batch_id)
            rows = _in_front(marked, carried).drop(ROW)
            found = alerts.order_pay_monitor(rows, key, time, arrival, F.col("_c"), F.col("_p"), within, keep=[arrival])
            found = hold(found)
            # A create that nothing followed yet is unpaid only when the watermark has reached the end of its span.
            waits = (F.col("kind") == "no_pay") & (ticks(found, "create_time") + width > F.lit(mark))
            kept = found.where(waits).select(key, F.col("create_time").alias(time), arrival, F.lit(True).alias("_c"),
                                             F.lit(False).alias("_p"))
            state.leave(kept, batch_id)
            return found.where(~waits).drop(arrival)

        return step

    return in_event_order(stream, time, delay, label, make)


def bursts(stream: DataFrame, keys: list[str], time: str, arrival: str, delay: str, fails: Column, within: str, at_least: int = 2,
           label: str = "burst") -> DataFrame:
    """``login_fail_burst`` on a stream. Carried: the rows of bursts whose span has not ended."""
    width = micros(within)

    def make(spark, path, hold):
        state = WholeRows(spark, path)

        def step(ready, batch_id, mark):
            marked = ready.select(*keys, time, arrival, fails.alias("_f"))
            carried = state.before(batch_id)
            rows = _in_front(marked, carried).drop(ROW)
            found = alerts.login_fail_burst(rows, keys, time, arrival, F.col("_f"), within, at_least=1)
            found = hold(found)
            waits = ticks(found, "first_time") + width > F.lit(mark)
            starts, same = _others(found.where(waits).select(*keys, F.col("first_time").alias("_from")), keys)
            kept = rows.join(starts, same & (F.col(time) >= F.col("_from"))).where("_f").select(*rows.columns)
            state.leave(kept, batch_id)
            return found.where(~waits & (F.col("n") >= at_least))

        return step

    return in_event_order(stream, time, delay, label, make)


def no_drop(stream: DataFrame, keys: list[str], time: str, arrival: str, delay: str, value: str, wait: str,
            label: str = "no-drop") -> DataFrame:
    """``no_drop_alert`` on a stream: an alert each ``wait`` up to the watermark. Carried: per key the newest value, the begin of the open
    stretch, and how many of its alerts are out. Every key may alert in every batch, so the table is written anew.
    """
    width = micros(wait)

    def make(spark, path, hold):
        state = WholeRows(spark, path)

        def step(ready, batch_id, mark):
            rows = ready.select(*keys, ticks(ready, time).alias("_at"), F.col(arrival).alias("_n"), F.col(value).cast("double").alias("_v"))
            carried = state.before(batch_id)
            # The carried row stands before all others and never drops; its time is the begin of the stretch (none: it ended in a drop).
            rows = _in_front(rows, carried)
            if "_since" not in rows.columns:
                rows = rows.withColumns({"_since": F.lit(None).cast("long"), "_out": F.lit(0).cast("long")})
            ordered = sequence(rows, keys, ["_at", "_n"]).running(_before=seq.previous("_v"))
            drop = (F.col(ROW) == 1) & F.coalesce(F.col("_v") < F.col("_before"), F.lit(False))
            ordered = ordered.mapped(lambda d: d.withColumn("_drop", drop)).running(_stretch=seq.tally(F.col("_drop")))
            ordered = ordered.reversed().running(_closing=seq.latest(F.when(F.col("_drop"), F.col("_at"))).before())
            began = F.when(F.col(ROW) == 0, F.col("_since")).when(~F.col("_drop"), F.col("_at"))
            stretches = ordered.df.groupBy(*keys, "_stretch").agg(
                F.min(began).alias("since"), F.max(F.coalesce("_out", F.lit(0))).alias("out"), F.max("_closing").alias("closing"),
                F.max_by("_v", F.struct("_at", "_n")).alias("_v"))
            stretches = hold(stretches)
            last = F.coalesce(F.col("closing") - 1, F.lit(mark))
            upto = F.greatest(F.coalesce(F.floor((last - F.col("since")) / width).cast("long"), F.lit(0)), F.col("out"))
            told = stretches.withColumn("upto", upto)
            kept = told.where("closing is null").select(
                *keys, F.lit(None).cast("long").alias("_at"), F.lit(None).cast(ready.schema[arrival].dataType).alias("_n"), "_v",
                F.col("since").alias("_since"), F.col("upto").alias("_out"))
            state.leave(kept, batch_id)
            nth = F.when(F.col("upto") > F.col("out"), F.sequence(F.col("out") + 1, "upto"))
            return told.select(*keys, "since", F.explode(nth).alias("nth")).withColumn("alert_at", F.col("since") + F.col("nth") * width)

        return step

    return in_event_order(stream, time, delay, label, make)


# ------------------------------------------------------------------------- re-fired windows

def allowed_lateness(stream: DataFrame, keys: list[str], time: str, size: str, delay: str, lateness: str, step: str | None = None,
                     value: str | None = None, label: str = "lateness") -> tuple[DataFrame, DataFrame]:
    """Counts (and sums of ``value``) of time windows, given out when the watermark passes their end and again in every batch that brings a
    late row, until ``lateness`` has passed too. Returns all firings, numbered from 0, and the rows that came too late for all their windows.

    Carried: the open windows with the number of their firings; they are purged at end plus lateness. The watermark a batch's rows are
    judged by is that of the batches before.
    """
    spark = stream.sparkSession
    out = Output(spark, scratch(spark, label))
    marks = EventOrder(spark, out.base, time, delay)
    late_us = micros(lateness)
    kinds = T.StructType([stream.schema[k] for k in keys])
    what = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kinds], "start long, stop long, n long, total double, firing long"])

    hold = Hold()

    def each(batch: DataFrame, batch_id: int) -> None:
        try:
            fire(hold(batch), batch_id)
        finally:
            hold.release()

    def fire(batch: DataFrame, batch_id: int) -> None:
        old, mark = marks.mark(batch_id - 1), marks.advance(batch, batch_id)
        at = ticks(batch, time)
        width, hop = micros(size), micros(step or size)
        last = at - F.pmod(at, F.lit(hop))
        starts = F.filter(F.sequence(last - (-(-width // hop) - 1) * hop, last, F.lit(hop).cast("long")), lambda s: s + width > at)
        keep = starts if old is None else F.filter(starts, lambda s: s + width + late_us > F.lit(old))
        judged = batch.where(F.col(time).isNotNull()).withColumn("_starts", keep)
        out.store(judged.where(F.size("_starts") == 0).drop("_starts"), batch_id, "late")
        total = F.sum(value).cast("double") if value else F.lit(None).cast("double")
        # Counted before the windows are opened: one row per key and group of windows.
        new = judged.groupBy(*keys, "_starts").agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(
            *keys, F.explode("_starts").alias("start"), "n", "total")
        new = new.groupBy(*keys, "start").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).select(
            *keys, "start", (F.col("start") + width).alias("stop"), "n", "total", F.lit(None).cast("long").alias("firing"), F.lit(True).alias("_new"))
        rows = new
        if batch_id:
            rows = new.unionByName(spark.read.schema(what).parquet(f"{out.base}/windows/{batch_id - 1}").withColumn("_new", F.lit(False)))
        windows = rows.groupBy(*keys, "start", "stop").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("firing").alias("firing"), F.max("_new").alias("_new"))
        limit = F.lit(mark if mark is not None else -(2**62)).cast("long")
        fires = (F.col("stop") <= limit) & (F.col("firing").isNull() | F.col("_new"))
        windows = windows.withColumn("_fires", fires).withColumn(
            "firing", F.when(F.col("_fires"), F.coalesce(F.col("firing") + 1, F.lit(0))).otherwise(F.col("firing")))
        windows = hold(windows)
        out.store(windows.where("_fires").select(*keys, "start", "stop", "firing", "n", "total"), batch_id)
        windows.where(F.col("stop") + late_us > limit).select(*keys, "start", "stop", "n", "total", "firing").write.mode("overwrite").parquet(
            f"{out.base}/windows/{batch_id}")

    run_batches(stream, each, out.base)
    return out.read(), out.read("late")

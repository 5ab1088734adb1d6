"""Keyed folds on a stream, through ``transformWithState``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from millrace.streaming.folds import Fold

AT = "_at"


class _Remembered(StatefulProcessor):
    """Shared part: one value state per key holding the fold's values."""

    def __init__(self, fold: Fold, state: T.StructType, out: list[str], keys: list[str], ttl: int | None):
        self.fold, self.state_type, self.names, self.keys, self.ttl = fold, state, out, keys, ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.state_type, self.ttl)

    def load(self):
        return tuple(self.kept.get()) if self.kept.exists() else self.fold.start()

    def keep(self, state: tuple) -> None:
        """A key that is back at its start values is forgotten."""
        if tuple(state) == self.fold.start():
            self.kept.clear()
        else:
            self.kept.update(state)

    def shown(self, key, values: tuple) -> Row:
        return Row(**dict(zip(self.keys, key)), **dict(zip(self.names, values)))

    def close(self) -> None:
        pass


class InArrivalOrder(_Remembered):
    """Rows in the order of the arrival column; a batch promises none by itself."""

    def __init__(self, *args, arrival: str):
        super().__init__(*args)
        self.arrival = arrival

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.load()
        for row in sorted(rows, key=lambda r: r[self.arrival]):
            state, out = self.fold.step(state, row)
            for values in out:
                yield self.shown(key, values)
        self.keep(state)


class InEventTime(_Remembered):
    """Rows wait until the watermark passes them and are then taken in event-time order.

    Deadlines of the fold that lie before a row are handled before it, the
    remaining ones when the watermark reaches them.
    """

    def __init__(self, *args, arrival: str, row_type: T.StructType):
        super().__init__(*args)
        self.arrival, self.row_type = arrival, row_type

    def init(self, handle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", self.row_type)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        earliest = None
        fields = self.row_type.names
        for row in rows:
            self.waiting.appendValue(tuple(row[f] for f in fields))
            earliest = row[AT] if earliest is None else min(earliest, row[AT])
        # A timer fires once the watermark is past it; one in the past fires at once.
        self.handle.registerTimer(max(earliest // 1000, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [Row(**dict(zip(self.row_type.names, values))) for values in self.waiting.get()]
        ready = sorted((r for r in rows if r[AT] <= mark), key=lambda r: (r[AT], r[self.arrival]))
        later = [r for r in rows if r[AT] > mark]
        state = self.load()
        for row in ready:
            state, out = self._expired(state, row[AT] - 1)
            yield from (self.shown(key, values) for values in out)
            state, out = self.fold.step(state, row)
            yield from (self.shown(key, values) for values in out)
        state, out = self._expired(state, mark)
        yield from (self.shown(key, values) for values in out)
        self.keep(state)
        self.waiting.clear()
        if later:
            self.waiting.put([tuple(r) for r in later])
        due = [r[AT] for r in later]
        deadline = self.fold.due(state)
        if deadline is not None:
            due.append(deadline)
        if due:
            self.handle.registerTimer(max(-(-min(due) // 1000), mark // 1000 + 1))

    def _expired(self, state: tuple, upto: int) -> tuple[tuple, list[tuple]]:
        shown = []
        while (due := self.fold.due(state)) is not None and due <= upto:
            state, out = self.fold.expire(state, due)
            shown.extend(out)
        return state, shown


def _types(df: DataFrame, keys: list[str], fold: Fold) -> tuple[T.StructType, T.StructType, T.StructType]:
    state = T.StructType.fromDDL(fold.state)
    out = T.StructType.fromDDL(fold.out)
    full = T.StructType([*[df.schema[k] for k in keys], *out.fields])
    return state, out, full


def fold_arrivals(df: DataFrame, keys: list[str], arrival: str, fold: Fold, ttl_ms: int | None = None) -> DataFrame:
    """One fold per key in arrival order.  ``ttl_ms`` forgets keys that stay silent."""
    state, out, full = _types(df, keys, fold)
    processor = InArrivalOrder(fold, state, out.names, keys, ttl_ms, arrival=arrival)
    mode = "ProcessingTime" if ttl_ms else "None"
    return df.groupBy(*keys).transformWithState(processor, full, "append", mode)


def fold_event_time(df: DataFrame, keys: list[str], time: str, arrival: str, fold: Fold) -> DataFrame:
    """One fold per key in event-time order; ``time`` must carry a watermark. Rows without a time are left out."""
    rows = df.where(F.col(time).isNotNull()).withColumn(AT, F.unix_micros(time))
    state, out, full = _types(rows, keys, fold)
    row_type = T.StructType([f for f in rows.schema.fields if f.name not in (*keys, time)])
    processor = InEventTime(fold, state, out.names, keys, None, arrival=arrival, row_type=row_type)
    return rows.groupBy(*keys).transformWithState(processor, full, "append", "EventTime")


class Periodic(StatefulProcessor):
    """A timer ``every_ms`` after each row of a key, armed again when it fires."""

    def __init__(self, keys: list[str], every_ms: int):
        self.keys, self.every = keys, every_ms

    def init(self, handle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for _ in rows:
            pass
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        yield Row(**dict(zip(self.keys, key)), fired_ms=expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def periodic_timer(df: DataFrame, keys: list[str], every_ms: int) -> DataFrame:
    """One row per key each time its timer fires (processing time, checked per micro-batch)."""
    out = T.StructType([*[df.schema[k] for k in keys], T.StructField("fired_ms", T.LongType())])
    return df.groupBy(*keys).transformWithState(Periodic(keys, every_ms), out, "append", "ProcessingTime")

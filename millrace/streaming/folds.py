"""What a key remembers between rows, one small fold per operator.

A fold sees the rows of one key one at a time.  ``step`` takes the remembered
values and a row and returns new values and output rows; ``due`` and ``expire``
give a fold a deadline in event time (microseconds, as everywhere here).
Folds hold a bounded number of values, so the state of a key stays small.

This is the way for rules of one's own that no built-in operator expresses, at one Python call per row and one task per
key. The operators of this library take the way of ``streaming.carried`` instead; the two folds below are examples.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

State = tuple
Rows = list[tuple]


@dataclass(frozen=True)
class Fold:
    """``state`` and ``out`` are schemas in DDL; ``out`` leaves out the key columns."""

    state: str = field(default="", init=False)
    out: str = field(default="", init=False)

    def start(self) -> State:
        raise NotImplementedError

    def step(self, state: State, row: Any) -> tuple[State, Rows]:
        raise NotImplementedError

    def due(self, state: State) -> int | None:
        return None

    def expire(self, state: State, at: int) -> tuple[State, Rows]:
        return state, []


@dataclass(frozen=True)
class MatchPair(Fold):
    """Pair the rows of two tagged inputs; the first to come waits."""

    side: str
    time: str
    state: str = field(default="left_at bigint, right_at bigint", init=False)
    out: str = field(default="left_at bigint, right_at bigint, completed_by string", init=False)

    def start(self):
        return (None, None)

    def step(self, state, row):
        left, right = state
        at = row[self.time]
        if row[self.side] == "l":
            return ((None, None), [(at, right, "left")]) if right is not None else ((at, None), [])
        return ((None, None), [(left, at, "right")]) if left is not None else ((None, at), [])


@dataclass(frozen=True)
class Consecutive(Fold):
    """``times`` adjacent hits in less than ``within``; every overlapping match."""

    hit: str
    time: str
    arrival: str
    times: int
    within: int
    state: str = field(default="ids array<bigint>, ats array<bigint>", init=False)
    out: str = field(default="arrival bigint, at bigint, first_arrival bigint, first_at bigint", init=False)

    def start(self):
        return ([], [])

    def step(self, state, row):
        if not row[self.hit]:
            return ([], []), []
        at, number = row[self.time], row[self.arrival]
        ids, ats = [*state[0], number][-self.times :], [*state[1], at][-self.times :]
        matched = len(ids) == self.times and at - ats[0] < self.within
        return (ids, ats), [(number, at, ids[0], ats[0])] if matched else []

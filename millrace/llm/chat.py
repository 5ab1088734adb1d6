"""Roles of raw transcripts by a hidden Markov model, and canonical rendering of the recovered turns.

A transcript is a sequence of lines. Hidden states are the roles, each as "begins a turn" and "goes on". What is seen of a
line is its speaker marker, if any, and its shape. The most probable sequence of states (Viterbi) tells where turns begin and
who speaks. Probabilities are counted from labelled conversations, marker and shape apart, with a little added to each count; the
counts are as small as the state space. A task decodes its many sequences side by side.

Long conversations are decoded in blocks of ``BLOCK_TURNS`` source turns: every block gives the best score from each
state before it to each state at its end, these small matrices are chained per conversation, and each block is then decoded
between its two known states. The result is the path of one Viterbi run over the whole conversation.

Defined results: a null text is an empty line; a null role takes part as an unlabelled line; lines of equal place are ordered by
their text; a null conversation id is a conversation of its own; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

ROLES = ("system", "user", "assistant")
STATES = [(r, b) for r in ROLES for b in (True, False)]
BLOCK_TURNS = 512
# How exports name the speakers.
NAMES = {
    "system": ("system", "context", "instruction", "instructions"),
    "user": ("user", "human", "customer", "q", "question"),
    "assistant": ("assistant", "ai", "bot", "agent", "a", "answer", "model"),
}
MARKER = re.compile(r"\s*(?:#+ *|\*\*|\[|<\|?)?(" + "|".join(n for names in NAMES.values() for n in names) + r")(?:\*\*)?\s*(?:\]|\|?>)?\s*[:>-](?:\*\*)?\s?", re.I)
ROLE_OF = {n: r for r, names in NAMES.items() for n in names}
MARKS = (*ROLES, "none")
SHAPES = ("empty", "question", "short", "middle", "long")


def split_marker(line: str) -> tuple[str, str]:
    """(role named by the speaker marker or ``none``, line without it)."""
    found = MARKER.match(line)
    return (ROLE_OF[found[1].lower()], line[found.end():]) if found else ("none", line)


def shape(line: str) -> str:
    if not line.strip():
        return "empty"
    if line.rstrip().endswith("?"):
        return "question"
    return "short" if len(line) < 60 else "middle" if len(line) < 240 else "long"


def symbols(lines: list[str]) -> np.ndarray:
    """Code of each line: marker and shape."""
    return read(lines)[0]


def read(lines: list[str]) -> tuple[np.ndarray, list[str]]:
    """(code of each line, the lines without their markers)."""
    parts = [split_marker(line) for line in lines]
    codes = [MARKS.index(m) * len(SHAPES) + SHAPES.index(shape(rest)) for m, rest in parts]
    return np.array(codes, np.int64), [rest for _, rest in parts]


def transcript(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The raw lines of every labelled turn as an export writes them, the first one behind the speaker's name."""
    name = F.when(F.col(role).isNull(), F.lit("")).otherwise(F.concat(F.initcap(role), F.lit(": ")))
    lines = F.split(F.concat(name, F.coalesce(F.col(text), F.lit(""))), "\n")
    return conversations.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), lines.alias("lines"))


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = (np.log(p / p.sum(axis=-1, keepdims=True)) for p in (start, move, emit))


def fit(turns: DataFrame) -> Model:
    """Counts over all labelled turns. A turn meets the next one by its number, so no conversation is gathered."""
    known = turns.where(F.col("role").isin(*ROLES))

    @F.pandas_udf("array<long>")
    def codes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([symbols(list(v)) for v in batch])

    marks, shapes = np.full((6, len(MARKS)), 1e-2), np.ones((6, len(SHAPES)))
    move, start = np.full((6, 6), 1e-3), np.full(6, 1e-3)
    coded = known.select("role", F.posexplode(codes("lines")).alias("at", "code"))
    for r in coded.groupBy("role", (F.col("at") == 0).alias("first"), "code").count().collect():
        state, (mark, kind) = STATES.index((r["role"], r["first"])), divmod(r["code"], len(SHAPES))
        marks[state, mark] += r["count"]
        shapes[state, kind] += r["count"]
    n = F.size("lines")
    for r in known.groupBy("role").agg(F.count("*").alias("n"), F.sum(n - 1).alias("on"), F.sum((n > 1).cast("long")).alias("longer")).collect():
        begin, on = STATES.index((r["role"], True)), STATES.index((r["role"], False))
        move[begin, on] += r["longer"]
        move[on, on] += r["on"] - r["longer"]
    last = F.when(n > 1, F.lit(False)).otherwise(F.lit(True)).alias("one")
    here = known.select("conv", "turn", F.col("role").alias("a"), last)
    after = known.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("b"))
    for r in here.join(after, ["conv", "turn"]).groupBy("a", "one", "b").count().collect():
        move[STATES.index((r["a"], r["one"])), STATES.index((r["b"], True))] += r["count"]
    for r in known.where("turn = 0").groupBy("role").count().collect():
        start[STATES.index((r["role"], True))] += r["count"]
    marks, shapes = (p / p.sum(axis=1, keepdims=True) for p in (marks, shapes))
    return Model(start, move, (marks[:, :, None] * shapes[:, None, :]).reshape(6, -1))


class Runs:
    """Sequences that lie one after the other in a flat array, walked side by side: step t meets the t-th item of each."""

    def __init__(self, lengths: np.ndarray):
        self.n = len(lengths)
        self.order = np.argsort(-lengths, kind="stable")
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        self.total = int(lengths.sum())
        longest_first = lengths[self.order]
        self.active = np.searchsorted(-longest_first, -np.arange(int(longest_first[0]) if self.n else 0), side="left")

    def __iter__(self) -> Iterator[np.ndarray]:
        """Places of the items of each step, for the sequences that reach so far, the longest first."""
        for t, n in enumerate(self.active):
            yield self.starts[:n] + t

    def __reversed__(self) -> Iterator[np.ndarray]:
        for t in range(len(self.active) - 1, -1, -1):
            yield self.starts[: self.active[t]] + t

    def restored(self, values: np.ndarray) -> np.ndarray:
        """Values per sequence, back in the order of the flat array."""
        out = np.empty_like(values)
        out[self.order] = values
        return out


def transfer(codes: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Best scores per sequence: of each state at its end from nothing before, and from each state before it."""
    runs = Runs(lengths)
    emit = model.emit.T[codes]
    through = np.tile(np.where(np.eye(6, dtype=bool), 0.0, -np.inf), (runs.n, 1, 1))
    alone = np.empty((runs.n, 6))
    for t, at in enumerate(runs):
        n = len(at)
        through[:n] = (through[:n, :, :, None] + model.move).max(axis=2) + emit[at][:, None, :]
        alone[:n] = (model.start if t == 0 else (alone[:n, :, None] + model.move).max(axis=1)) + emit[at]
    return runs.restored(alone), runs.restored(through)


def best_path(runs: Runs, first: np.ndarray, step, ends: np.ndarray | None) -> np.ndarray:
    """The best state at each place. ``first``: scores of the first item of each sequence; ``step(score, at)``: scores by
    (sequence, state before, state there); ``ends``: the known last states, if any."""
    score, back = first[runs.order], np.zeros((runs.total, 6), np.int8)
    for t, at in enumerate(runs):
        if t:
            ways = step(score[: len(at)], at)
            back[at] = ways.argmax(axis=1)
            score[: len(at)] = ways.max(axis=1)
    state = score.argmax(axis=1) if ends is None else ends[runs.order]
    path = np.empty(runs.total, np.int64)
    for at in reversed(runs):
        path[at] = state[: len(at)]
        state[: len(at)] = back[at, path[at]]
    return path


def decode(codes: np.ndarray, lengths: np.ndarray, model: Model, before: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The best states of each sequence between a state before it (-1: none) and the state at its end."""
    runs, emit = Runs(lengths), model.emit.T[codes]
    entry = np.where(before[:, None] < 0, model.start, model.move[before])
    first = entry + emit[np.cumsum(lengths) - lengths]
    return best_path(runs, first, lambda score, at: score[:, :, None] + model.move + emit[at][:, None, :], ends)


def blocks_in_order(frame: pd.DataFrame) -> tuple[pd.DataFrame, list[str], np.ndarray]:
    """(first row of each block, all lines by block, turn number and then text, number of lines per block)."""
    lines = [list(v) for v in frame["lines"]]
    keys = list(zip(frame["conv"], frame["block"], frame["turn"].isna(), frame["turn"].fillna(0), lines, strict=True))
    order = sorted(range(len(keys)), key=keys.__getitem__)
    frame = frame.iloc[order]
    begins = ~frame.duplicated(["conv", "block"]).to_numpy()
    n_lines = np.array([len(lines[k]) for k in order], np.int64)
    return frame[begins], [line for k in order for line in lines[k]], np.add.reduceat(n_lines, np.flatnonzero(begins))


NO_CONVERSATION = "\x00"
ROWS_PER_TASK = 2000


def parse(turns: DataFrame, model: Model) -> DataFrame:
    """``conv``, ``turn`` (from 0), ``role``, ``n_lines``, ``text`` and ``rendered`` of every recovered turn."""
    kind = turns.schema["conv"].dataType
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-1)).cast("long")
    rows = turns.select(F.coalesce(F.col("conv").cast("string"), F.lit(NO_CONVERSATION)).alias("conv"), block.alias("block"), "turn", "lines")
    n_parts = max(64, -(-turns.count() // ROWS_PER_TASK))
    part = lambda *keys: F.pmod(F.xxhash64(*keys), F.lit(n_parts)).alias("part")

    def scores(frame):
        heads, lines, lengths = blocks_in_order(frame)
        alone, through = transfer(symbols(lines), lengths, model)
        return pd.DataFrame({"conv": heads["conv"].array, "block": heads["block"].array, "alone": list(alone), "through": list(through.reshape(-1, 36))})

    def chain(frame):
        frame = frame.sort_values(["conv", "block"])
        begins = ~frame.duplicated("conv").to_numpy()
        lengths = np.diff([*np.flatnonzero(begins), len(frame)])
        through = np.stack(frame["through"].to_list()).reshape(-1, 6, 6)
        first = np.stack(frame["alone"][begins].to_list())
        ends = best_path(Runs(lengths), first, lambda score, at: score[:, :, None] + through[at], None)
        return pd.DataFrame({"conv": frame["conv"].array, "block": frame["block"].array, "before": np.where(begins, -1, np.roll(ends, 1)), "end": ends})

    def turns_of(frame):
        heads, lines, lengths = blocks_in_order(frame)
        codes, bare = read(lines)
        path = decode(codes, lengths, model, heads["before"].to_numpy(np.int64), heads["end"].to_numpy(np.int64))
        head = np.cumsum(lengths) - lengths
        begins = path % 2 == 0  # the even states begin a turn
        cut = begins.copy()
        cut[head] = True
        at = np.flatnonzero(cut)
        block = np.repeat(np.arange(len(lengths)), lengths)[at]
        nth = np.arange(len(at)) - np.searchsorted(at, head)[block]
        texts = ["\n".join([bare[a] if begins[a] else lines[a], *lines[a + 1 : z]]) for a, z in zip(at, [*at[1:], len(lines)], strict=True)]
        return pd.DataFrame({
            "conv": heads["conv"].array[block], "block": heads["block"].array[block], "nth": nth, "role": [STATES[k][0] for k in path[at]],
            "begins": begins[at], "n_lines": np.diff([*at, len(lines)]), "text": texts,
        })

    matrices = rows.groupBy(part("conv", "block")).applyInPandas(
        scores, "conv string, block long, alone array<double>, through array<double>")
    ends = matrices.groupBy(part("conv")).applyInPandas(
        chain, "conv string, block long, before int, end int")
    parts = stored(rows.join(ends, ["conv", "block"]).groupBy(part("conv", "block")).applyInPandas(
        turns_of, "conv string, block long, nth long, role string, begins boolean, n_lines long, text string"), "turn-parts")
    # Turn numbers: begun turns of the blocks before, then of the block. A turn that goes on over a block's end is put together.
    begun = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = parts.groupBy("conv", "block").agg(F.sum(F.col("begins").cast("long")).alias("n"), F.min("begins").alias("all_begin"))
    earlier = per_block.select("conv", "block", "all_begin", F.coalesce(F.sum("n").over(begun), F.lit(0)).alias("earlier"))
    here = F.col("nth") - F.when(F.col("all_begin"), 0).otherwise(1) + F.col("earlier")
    whole = parts.join(earlier, ["conv", "block"]).withColumn("at", here).groupBy("conv", "at").agg(
        F.min("role").alias("role"), F.sum("n_lines").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n").alias("text"))
    return whole.select(
        F.when(F.col("conv") != NO_CONVERSATION, F.col("conv")).cast(kind).alias("conv"), F.col("at").alias("turn"), "role", "n_lines", "text",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")).alias("rendered"))

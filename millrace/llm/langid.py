"""Language by cross-parsing entropy: who needs the fewest phrases of its own text to write this one?

A bounded sample of labelled rows per language is turned into a suffix automaton, which knows every substring of it. A
document is cut into the longest phrases that the automaton of a language accepts; the number of phrases, times the bits that name a
place in that language's sample, per character, estimates the cross entropy. The smallest wins.

Texts are read as letters in lower case with one blank for each run of other characters, and are parsed in stretches of
``STRETCH`` characters, all stretches of a batch side by side. Every letter of the samples is kept, of whatever script: the
``COLUMNS`` most frequent letters of a language have a dense table of transitions, the rest a sorted list of (state, letter).

Bounds (parameters): ``SAMPLE_ROWS`` rows and ``SAMPLE_CHARS`` characters of each, per language, are collected; the model is built from
``MOST_CHARS`` characters in all, so it has at most twice as many states and ``8 * COLUMNS * MOST_CHARS`` bytes of tables.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the alphabetically first language;
without any labelled row everything is ``und``; rows are judged one by one, so repeated rows repeat their result, and a repeated labelled
row fills its place in the sample again; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 128
SAMPLE_CHARS = 200
MOST_CHARS = 400_000
STRETCH = 1024
GROUP_BYTES = 4 << 20
UNKNOWN = "und"
COLUMNS = 64


def labelled(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang") -> list[tuple[str, str]]:
    """A bounded sample, the rows of smallest hash per language, each cut to ``SAMPLE_CHARS``."""
    usable = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    by_hash = Window.partitionBy("label").orderBy("h", "text")
    few = usable.select(
        F.col(label).alias("label"), F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.xxhash64(key, text).alias("h")
    ).withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= SAMPLE_ROWS)
    return sorted((r["label"], r["text"]) for r in few.select("label", "text").collect())


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a text: one map from code to state per state, the start first."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Transitions:
    """An automaton as arrays. Column 0 of the dense table is empty: codes that the automaton does not know lead there."""

    def __init__(self, step: list[dict[int, int]], codes: np.ndarray, size: int):
        self.size = size
        counts = np.bincount(codes, minlength=size)
        dense = [c for c in np.argsort(-counts, kind="stable")[: COLUMNS - 1].tolist() if counts[c]]
        self.column = np.where(counts > 0, -1, 0).astype(np.int32)
        self.column[dense] = np.arange(1, len(dense) + 1)
        self.width = len(dense) + 1
        self.flat = np.full(len(step) * self.width, -1, np.int32)
        keys, targets = [], []
        for state, to in enumerate(step):
            for c, t in to.items():
                if self.column[c] > 0:
                    self.flat[state * self.width + self.column[c]] = t
                else:
                    keys.append(state * size + c)
                    targets.append(t)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.targets = np.array(keys, np.int64)[order], np.array(targets, np.int32)[order]
        self.root = np.full(size, -1, np.int32)
        self.root[list(step[0])] = list(step[0].values())

    def follow(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state after each code, -1 for none."""
        column = self.column[code]
        to = self.flat[state * self.width + column]
        if len(self.keys):
            rare = np.flatnonzero(column < 0)
            if rare.size:
                key = state[rare] * self.size + code[rare]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                to[rare] = np.where(self.keys[at] == key, self.targets[at], -1)
        return to


class Model:
    """Automata of all languages over one alphabet. Codes: 0 blank, 1 any letter not in the samples, then the letters."""

    def __init__(self, rows: list[tuple[str, str]]):
        texts: dict[str, list[str]] = {}
        for label, text in rows:
            texts.setdefault(label, []).append(text)
        self.labels = sorted(texts)
        share = MOST_CHARS // max(1, len(self.labels))
        joined = {k: "\n".join(v)[:share] for k, v in texts.items()}
        letters = sorted({c for t in joined.values() for c in t.lower() if c.isalpha()})
        code = {c: i + 2 for i, c in enumerate(letters)}
        self.of_char = np.zeros(0x110000, np.uint16 if len(letters) + 2 < 1 << 16 else np.int32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                self.of_char[point] = code.get(char.lower(), 1)
        self.tables, self.bits = [], []
        for label in self.labels:
            codes, _ = self.codes([joined[label]])
            self.tables.append(Transitions(automaton(codes.tolist()), codes, len(letters) + 2))
            self.bits.append(math.log2(max(2, len(codes))))

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts in a row, and where each text begins and the last one ends."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        raw = self.of_char[points]
        ends = np.cumsum([0, *map(len, texts)])
        keep = np.ones(len(raw), bool)
        keep[1:] = (raw[1:] != 0) | (raw[:-1] != 0)
        keep[ends[:-1][ends[:-1] < len(raw)]] = True
        return raw[keep], np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])[ends].astype(np.int64)

    def parsed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text (rows) in each language, the length of the text as read, and whether it has a letter."""
        codes, ends = self.codes(texts)
        n = np.diff(ends)
        letters = np.concatenate([[0], np.cumsum(codes > 0, dtype=np.int32)])
        counts = -(-n // STRETCH)
        of = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = ends[:-1][of] + nth * STRETCH
        size = np.minimum(STRETCH, ends[1:][of] - begin)
        order = np.argsort(-size, kind="stable")
        begin, size, of = begin[order], size[order], of[order]
        alive = len(size) - np.searchsorted(size[::-1], np.arange(1, STRETCH + 1))
        out = np.zeros((len(texts), len(self.labels)))
        for k, table in enumerate(self.tables):
            state = np.zeros(len(size), np.int64)
            phrases = np.zeros(len(size), np.int64)
            for t in range(STRETCH):
                m = alive[t]
                if not m:
                    break
                c = codes[begin[:m] + t]
                to = table.follow(state[:m], c)
                miss = np.flatnonzero(to < 0)
                if miss.size:
                    fresh = table.root[c[miss]]
                    phrases[miss] += 1 + ((fresh < 0) & (state[miss] > 0))
                    to[miss] = np.maximum(fresh, 0)
                state[:m] = to
            phrases += state > 0
            out[:, k] = np.bincount(of, phrases, len(texts))
        return out, n, letters[ends[1:]] > letters[ends[:-1]]


RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType()),
    T.StructField("phrases", T.LongType()),
])
# A text whose phrases are shorter than this on average, the first one left aside, is in none of the languages.
LEAST_PHRASE = 1.5


def judge(model: Model, texts: list[str]) -> tuple[np.ndarray, ...]:
    """Language, lead over the second (0 to 1), bits per character and phrases of each text."""
    phrases, sizes, has = model.parsed(texts)
    rates = phrases * np.array(model.bits) / np.maximum(sizes, 1)[:, None]
    every = np.arange(len(texts))
    best, score, bits = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
    count = np.zeros(len(texts), np.int64)
    if model.labels:
        best = rates.argmin(axis=1)
        bits, count = rates[every, best], phrases[every, best].astype(np.int64)
        rates[every, best] = np.inf
        second = rates.min(axis=1)
        score = np.where(np.isfinite(second), 1 - bits / np.where(np.isfinite(second) & (second > 0), second, 1), 1.0)
    names = np.array([*model.labels, UNKNOWN], object)
    return (names[np.where(has, best, len(model.labels))], np.where(has, np.clip(score, 0, 1), 0.0), np.where(has, bits, 0.0),
            np.where(has, count, 0))


def groups(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about ``GROUP_BYTES``, which bound the arrays of a worker."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    at = 0
    while at < len(texts):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_BYTES, side="right")))
        yield texts.slice(at, until - at)
        at = until


def predicted(docs: DataFrame, model: Model, *, text: str = "text", result: str = "language") -> DataFrame:
    """All columns, and a struct of ``lang_pred``, ``score`` (lead over the second language), ``bits`` per character and ``phrases``."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays, bounded by MOST_CHARS

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = object.__new__(Model)
        vars(model).update(shipped.value)
        for batch in batches:
            parts = [judge(model, part.to_pylist()) for part in groups(batch)]
            lang, score, bits, phrases = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else ([], [], [], [])
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()), pa.array(phrases, pa.int64())],
                RESULT.names)

    # Told once per text: a deterministic function is evaluated anew in a filter and in each later use of its result.
    tell = F.arrow_udf(run, RESULT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    return docs.withColumn(result, tell(F.coalesce(F.col(text), F.lit(""))))


def doubtful(language: str, text: str = "text") -> Column:
    """Whether a text is in none of the learned languages: without a letter, or put together from phrases of a letter or two."""
    told = F.col(language)
    return (told["lang_pred"] == UNKNOWN) | ((told["phrases"] - 1) * LEAST_PHRASE > F.length(text))


def held_out(key: str = "doc_id"):
    """The rows that are never learned from: a quarter, by the checksum of the key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", result: str = "language") -> DataFrame:
    """Learn from the labelled rows outside the held-out quarter, then predict every row: all columns and a struct ``result``."""
    model = Model(labelled(docs.where(~held_out(key)), key=key, text=text, label=label))
    return predicted(docs, model, text=text, result=result)

"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every feature ``i`` has a weight ``w_i`` and a short vector ``v_i``; a document with values ``x_i`` scores

    sigmoid(b + sum w_i x_i + 1/2 sum_k ((sum_i v_ik x_i)^2 - sum_i (v_ik x_i)^2))

The last term is the sum of ``<v_i, v_j> x_i x_j`` over all pairs of features, in time linear in the features present.

Features of a whole text: one per hashed word bin (log count, the block of words scaled to length one), and one bin each of
``STATISTICS``, cut at fixed bounds. Metadata: the declared ``n_chars`` by order of magnitude, its ratio to the real length, and whether
it is missing. Labels, language, source and id are no inputs.

The model is fitted on a bounded sample (``SAMPLE_ROWS`` labelled rows per class, those of smallest hash); weights of the rows restore
the share that each class has among all labelled rows, so that scores are probabilities. The sample's features are at
most ``SAMPLE_ROWS * 2 * (WORD_BINS + a few)`` numbers on the driver; the model has ``BINS * (1 + RANK)``.

Defined results: a null text is an empty one and scores by its statistics. Rows are judged one by one. A document with several label
rows is good if one says so; other labels than 0 and 1 and rows without an id are not learned from. Without labels of both classes
every score is the share of good ones (0.5 without any label). Further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BINS = 4096
RANK = 8
SAMPLE_ROWS = 3000
UPDATES = 400
BATCH = 256
RATE = 0.02
DECAY = 1e-5
THRESHOLD = 0.3
SYMBOLS = "#*$%&|<>"

# Statistics of a text and the bounds between their bins.
STATISTICS: dict[str, tuple[float, ...]] = {
    "words": (1, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000),
    "word_length": (1, 2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15),
    "distinct_words": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97),
    "symbols": (0.0005, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3),
    "capitals": (0.001, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2, 0.5),
    "digits": (0.0005, 0.002, 0.01, 0.03, 0.1, 0.3),
    "punctuation": (0.001, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2),
    "line_words": (1, 2, 4, 8, 16, 32, 64, 128),
    "repeated_lines": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8),
    "top_word": (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.25, 0.5),
    "declared": (1, 2, 4, 6, 8, 10, 12, 14, 16, 18),
    "declared_ratio": (0.5, 0.9, 0.999, 1.001, 1.1, 2),
    "undeclared": (0.5,),
}
_WIDTHS = [len(b) + 1 for b in STATISTICS.values()]
_STARTS = WORD_BINS + np.concatenate([[0], np.cumsum(_WIDTHS)])[:-1]
BINS = WORD_BINS + sum(_WIDTHS)


def _set(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), list(chars.encode("ascii")))


_SYMBOLS, _CAPITALS, _DIGITS, _PUNCTUATION = map(_set, (SYMBOLS, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:!?\"'()-"))


def features(text: bytes, declared: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one document, its text in UTF-8."""
    words = text.split()
    hashed = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_BINS
    counts = np.bincount(hashed, minlength=WORD_BINS)
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at])
    values /= max(1e-12, float(np.sqrt((values**2).sum())))
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(seen[0x80:0xC0].sum())
    size, n = max(1, points), max(1, len(words))
    lines = [line for line in text.split(b"\n") if line]
    stated = points if declared is None else max(0, declared)
    own = (
        len(words), sum(map(len, words)) / n, len(set(words)) / n, seen[_SYMBOLS].sum() / size, seen[_CAPITALS].sum() / size,
        seen[_DIGITS].sum() / size, seen[_PUNCTUATION].sum() / size, len(words) / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), counts.max() / n, np.log2(1 + stated), (1 + stated) / (1 + points), declared is None,
    )
    bins = [s + np.searchsorted(b, v, "right") for s, b, v in zip(_STARTS, STATISTICS.values(), own, strict=True)]
    return np.concatenate([at, bins]), np.concatenate([values, np.full(len(bins), len(bins) ** -0.5)])


class Machine:
    """Bias, weights and vectors."""

    def __init__(self, bias: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.b = np.array([bias])
        self.w = np.zeros(BINS)
        self.v = rng.normal(0, 0.05, (BINS, RANK))

    def scores(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probabilities of documents whose features follow each other; ``starts`` is where each begins (none is empty)."""
        if not len(starts):
            return np.zeros(0)
        vx = self.v[ids] * x[:, None]
        sums, squares = np.add.reduceat(vx, starts), np.add.reduceat((vx * vx).sum(axis=1), starts)
        z = self.b[0] + np.add.reduceat(self.w[ids] * x, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, weight: np.ndarray, seed: int = 12) -> Machine:
        """Weighted log loss by Adam, in batches of rows written out over all bins."""
        rng = np.random.default_rng(seed)
        parts = (self.b, self.w, self.v)
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        order = np.concatenate([rng.permutation(len(rows)) for _ in range(-(-UPDATES * BATCH // len(rows)))])
        for t in range(1, UPDATES + 1):
            at = order[(t - 1) * BATCH : t * BATCH]
            x = np.zeros((len(at), BINS))
            for i, row in enumerate(at):
                x[i, rows[row][0]] = rows[row][1]
            xv = x @ self.v
            x2 = x * x
            z = self.b[0] + x @ self.w + 0.5 * ((xv * xv) - x2 @ (self.v * self.v)).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - good[at]) * weight[at] / len(at)
            # d z / d v_ik = x_i * (sum_j v_jk x_j - v_ik x_i)
            slopes = (np.array([g.sum()]), x.T @ g, x.T @ (g[:, None] * xv) - self.v * (x2.T @ g)[:, None])
            for p, d, m, s in zip(parts, slopes, first, second, strict=True):
                d = d if p is self.b else d + DECAY * p
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return self


def held_out(key: str = "doc_id") -> Column:
    """The rows whose labels are never learned from: a fifth, by the checksum of the key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def _inputs(docs: DataFrame, text: str, declared: str) -> list[Column]:
    stated = F.col(declared).cast("long") if declared in docs.columns else F.lit(None).cast("long")
    return [F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"), stated.alias("c")]


def sample(docs: DataFrame, labels: DataFrame, *, key: str, text: str, declared: str):
    """Features and label of the sampled rows, and how many labelled rows each class has."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).alias("k")).agg(F.max("quality").alias("good"))
    classes = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    few = [known.where(F.col("good") == c).orderBy(F.xxhash64("k"), "k").limit(SAMPLE_ROWS) for c in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # at most 2 * SAMPLE_ROWS ids
    rows = docs.select(F.col(key).alias("k"), *_inputs(docs, text, declared)).join(chosen, "k").select("k", "good", "t", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_buffer().to_pybytes(), c) for t, c in zip(batch.column("t"), batch.column("c").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("good").cast(pa.int32()),
                pa.array([i.astype("<u2").tobytes() for i, _ in found], pa.binary()),
                pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary()),
            ], ["good", "i", "x"])

    # A repeated document is one example, always the same, so that the sample stays bounded.
    one = rows.groupBy("k").agg(F.min_by(F.struct("good", "t", "c"), F.xxhash64("t", "c")).alias("r")).select("k", "r.*")
    seen = one.mapInArrow(run, "good int, i binary, x binary").collect()
    seen = sorted(seen, key=lambda r: (r["good"], bytes(r["i"]), bytes(r["x"])))
    return [(np.frombuffer(r["i"], "<u2").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(float)) for r in seen], \
        np.array([r["good"] for r in seen], float), classes


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", declared: str = "n_chars") -> Machine:
    rows, good, classes = sample(docs, labels, key=key, text=text, declared=declared)
    total = sum(classes.values())
    share = classes.get(1, 0) / total if total else 0.5
    logit = float(np.log(share / (1 - share))) if 0 < share < 1 else 50.0 * (2 * share - 1)
    machine = Machine(logit)
    if len(set(good)) < 2:
        machine.v[:] = 0
        return machine
    each = {c: classes[c] / total / (good == c).mean() for c in (0, 1)}
    return machine.fit(rows, good, np.where(good == 1, each[1], each[0]))


def scored(docs: DataFrame, machine: Machine, *, text: str = "text", declared: str = "n_chars", result: str = "quality_score") -> DataFrame:
    """All columns, and the probability that a document is good."""
    shipped = docs.sparkSession.sparkContext.broadcast(vars(machine))  # BINS * (1 + RANK) numbers

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machine = object.__new__(Machine)
        vars(machine).update(shipped.value)
        for texts, stated in batches:
            out = []
            for a in range(0, len(texts), 256):
                some = zip(texts.slice(a, 256), stated.slice(a, 256).to_pylist(), strict=True)
                rows = [features(t.as_buffer().to_pybytes(), c) for t, c in some]
                starts = np.cumsum([0, *(len(i) for i, _ in rows)])[:-1]
                out.append(machine.scores(np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), starts))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return docs.withColumn(result, F.arrow_udf(run, T.DoubleType(), F.ArrowUDFType.SCALAR_ITER)(*_inputs(docs, text, declared)))


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", declared: str = "n_chars",
             result: str = "quality_score") -> DataFrame:
    """Learn from the labelled rows outside the held-out fifth, then score every row."""
    return scored(docs, train(docs, labels, key=key, text=text, declared=declared), text=text, declared=declared, result=result)

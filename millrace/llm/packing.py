"""Packing by non-negative least squares over shallow length combinations.

Documents become token ids, are cut where they exceed a window, and the lengths of all pieces are counted in classes of
``CLASS`` tokens. That histogram, of fixed size however large the corpus, goes to the driver. There, all combinations of up
to ``DEPTH`` classes that fill a window are enumerated, their repeat counts are solved by non-negative least squares against
the histogram and rounded down, and what is left is packed greedily, still class by class. The outcome is a list of
patterns with repeat counts, which the executors apply: the n-th piece of a class knows its pattern, copy and place.

Defined results: a null text is empty and gives the one piece that holds the end id; repeated rows are packed as often as
they occur; further columns are not read; an empty table gives no rows. Padding is at most ``CLASS - 1`` tokens per piece
besides the space that the greedy part leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import encoder
from millrace.session import stored

WINDOW = 4096
CLASS = 16
DEPTH = 4
END = 2
BLOCK_ROWS = 10_000

PIECES = "key {}, start long, length long, ids binary, doc_tokens long"


# ---------------------------------------------------------------- pieces

def pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Ids of every document with the end id, cut into pieces of at most a window."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer).encode_all
        for batch in batches:
            of, start, length, ids, total = [], [], [], [], []
            for row, mine in enumerate(encode_all(batch.column("text"))):
                mine += end
                for at in range(0, len(mine), 4 * window):
                    piece = mine[at : at + 4 * window]
                    of.append(row)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    ids.append(piece)
                    total.append(len(mine) // 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(of, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                ["key", "start", "length", "ids", "doc_tokens"],
            )

    return rows.mapInArrow(run, PIECES.format(kind)).withColumnRenamed("key", key)


# ---------------------------------------------------------------- patterns, on the driver, of fixed size

def combinations(classes: list[int], top: int, depth: int) -> np.ndarray:
    """Rows of up to ``depth`` ascending classes (0: none) that add up to ``top``."""
    here = np.zeros(top + 1, bool)
    here[classes] = True
    usable = np.array(sorted(c for c in classes if c <= top), np.int64)
    heads = np.zeros((1, 0), np.int64)
    found = []
    for n in range(1, depth + 1):
        left = top - heads.sum(axis=1)
        least = heads[:, -1] if n > 1 else np.ones(1, np.int64)
        ok = (left >= least) & (left > 0)
        ok[ok] = here[left[ok]]
        last = np.hstack([heads[ok], left[ok, None]])
        found.append(np.pad(last, ((0, 0), (0, depth - n))))
        if n < depth:
            longer = [np.hstack([heads[m], np.full((m.sum(), 1), c)])
                      for c in usable if (m := (left - c >= c) & (least <= c)).any()]
            if not longer:
                break
            heads = np.vstack(longer)
    return np.vstack(found)


def nonnegative_counts(parts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Active-set non-negative least squares: repeats per combination whose class counts come closest to ``wanted``."""
    n_classes = len(wanted)
    x = np.zeros(len(parts))
    scale = max(1.0, wanted.max(initial=0))
    goal = wanted / scale
    column = lambda k: np.bincount(parts[k][parts[k] > 0], minlength=n_classes).astype(float)
    active: list[int] = []
    basis = np.zeros((n_classes, 0))
    values = np.zeros(0)
    barred = np.zeros(len(parts), bool)
    for _ in range(4 * n_classes):
        rest = goal - basis @ values
        rest[0] = 0
        gain = rest[parts].sum(axis=1)
        gain[active] = -1
        gain[barred] = -1
        best = int(np.argmax(gain)) if len(gain) else -1
        if best < 0 or gain[best] <= 1e-9:
            break
        active.append(best)
        basis = np.hstack([basis, column(best)[:, None]])
        values = np.append(values, 0.0)
        while True:
            gram = basis.T @ basis + 1e-10 * np.eye(len(active))
            free = np.linalg.solve(gram, basis.T @ goal)
            if free.min() > 0:
                values = free
                break
            low = free <= 0
            steps = values[low] / np.maximum(values[low] - free[low], 1e-300)
            values = np.maximum(values + steps.min() * (free - values), 0)
            stay = values > 1e-12
            if stay.all():
                stay[np.argmin(values)] = False
            if not stay[-1] and active[-1] == best:
                barred[best] = True
            active = [k for k, s in zip(active, stay, strict=True) if s]
            basis, values = basis[:, stay], values[stay]
            if not active:
                break
    x[active] = values * scale
    return x


def patterns(histogram: dict[int, int], top: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(classes of one window, repeats) that use up the histogram exactly."""
    left = np.zeros(top + 1, np.int64)
    for c, n in histogram.items():
        left[c] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def use(classes: tuple[int, ...], most: int) -> None:
        kinds, times = np.unique(classes, return_counts=True)
        repeats = int(min(most, (left[kinds] // times).min()))
        if repeats > 0:
            left[kinds] -= repeats * times
            out.append((classes, repeats))

    present = [int(c) for c in np.flatnonzero(left)]
    parts = combinations(present, top, depth) if present else np.zeros((0, depth), np.int64)
    solved = nonnegative_counts(parts, left.astype(float)) if len(parts) else np.zeros(0)
    for k in np.argsort(-solved, kind="stable"):
        if solved[k] < 1:
            break
        use(tuple(int(c) for c in parts[k] if c), int(solved[k]))
    # The rest: largest class first, each gap filled with the largest class that fits, repeated while stocks last.
    while left.any():
        stock, gap, chosen = left.copy(), top, []
        while gap and (fits := np.flatnonzero(stock[: gap + 1])).size:
            c = int(fits[-1])
            take = int(min(stock[c], gap // c))
            chosen += [c] * take
            stock[c] -= take
            gap -= take * c
        use(tuple(chosen), int(left.sum()))
    return out


# ---------------------------------------------------------------- applying them

def _intervals(found: list[tuple[tuple[int, ...], int]], n_classes: int) -> dict[str, np.ndarray]:
    """For each class, stretches of ranks that one pattern takes, in flat arrays sorted by (class, first rank)."""
    rows, taken, first = [], np.zeros(n_classes + 1, np.int64), 0
    for classes, repeats in found:
        kinds, at, times = np.unique(classes, return_index=True, return_counts=True)
        for c, place, m in zip(kinds, at, times, strict=True):
            rows.append((int(c), int(taken[c]), int(m), first, int(place)))
            taken[c] += repeats * m
        first += repeats
    rows.sort()
    c, start, times, base, place = (np.array(v, np.int64) for v in zip(*rows, strict=True))
    return {"code": (c << 44) + start, "start": start, "times": times, "base": base, "place": place}


def pack(cut: DataFrame, *, window: int = WINDOW, class_size: int = CLASS) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``. ``cut`` has a ``length`` between 1 and the window, and any further columns."""
    top = window // class_size
    kind = F.ceil(F.col("length") / class_size).cast("int")
    rows = stored(cut.withColumn("pk_class", kind).withColumn("pk_row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["pk_class"]: r["n"] for r in rows.groupBy("pk_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not histogram:
        return cut.selectExpr("*", "cast(null as long) as sequence_id", "cast(null as long) as offset").where("false")
    table = _intervals(patterns(histogram, top), top)

    # The rank of a piece within its class: its rank in a block of bounded size, plus the sizes of the blocks before.
    n_blocks = -(-sum(histogram.values()) // BLOCK_ROWS)
    blocks = rows.withColumn("pk_block", F.pmod(F.xxhash64("pk_row"), F.lit(n_blocks)))
    sizes = blocks.groupBy("pk_class", "pk_block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("pk_class").orderBy("pk_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("pk_class", "pk_block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("pk_before"))
    inside = F.row_number().over(Window.partitionBy("pk_class", "pk_block").orderBy("pk_row")) - 1
    ranked = blocks.withColumn("pk_inside", inside).join(before, ["pk_class", "pk_block"])

    @F.pandas_udf("sequence_id long, place long")
    def assign(of: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(table["code"], (of.to_numpy(np.int64) << 44) + rank.to_numpy(np.int64), side="right") - 1
        nth = rank.to_numpy(np.int64) - table["start"][at]
        times = table["times"][at]
        return pd.DataFrame({"sequence_id": table["base"][at] + nth // times, "place": table["place"][at] + nth % times})

    placed = ranked.withColumn("pk_to", assign(F.col("pk_class"), F.col("pk_before") + F.col("pk_inside")))
    ahead = Window.partitionBy("pk_to.sequence_id").orderBy("pk_to.place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *[F.col(c) for c in cut.columns],
        F.col("pk_to.sequence_id").alias("sequence_id"),
        F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"),
    )

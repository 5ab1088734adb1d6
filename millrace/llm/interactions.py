"""Filter interaction audit: what every order of five filters removes, from 32 stored states per part of a corpus.

``judged`` reads every text once and sets a bit per failed filter; ``cells`` counts documents per (part, bits), 32 cells a part at
most. ``walk`` visits all subsets of filters in Gray-code order, so that each step toggles one filter: a cell's counter of active
failures goes up or down by one, and the running survivors change only where a counter leaves or reaches zero. The 32 states are
stored; every step of every order is the difference of two of them (``steps``).

Filters, by what fails them: A under 200 words; B 100 * distinct words < 50 * words; C 100 * capitals A-Z > 3 * code points; D any
of ``#$%&*|``; E the same text as a row of smaller id, anywhere in the table.

Defined results: a null text is an empty one; an empty text fails A only (and E). A null part is the empty string. Rows are counted
one by one, repeated ones too; rows of the smallest id of a text never fail E, nor does a row without an id, which makes no other row
fail either. A document is good or toxic if any label row of its id says so. Texts count as equal if their SHA-256 are. Further columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

FILTERS = "ABCDE"
LEAST_WORDS = 200
STATES = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
# Orders in which exactly ``k`` given filters stand before another one.
WEIGHTS = [24, 6, 4, 6, 24]
COUNTED = ("n", "good", "toxic")
_CAPITALS = slice(ord("A"), ord("Z") + 1)
_SIGNS = np.frombuffer(b"#$%&*|", np.uint8)


def own_bits(text: bytes) -> int:
    """The bits of filters A to D for one text in UTF-8."""
    words = text.split()
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(seen[0x80:0xC0].sum())
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * int(seen[_CAPITALS].sum()) > 3 * points) << 2
        | bool(seen[_SIGNS].any()) << 3
    )


def judged(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Id, part, digest of the text and bits of filters A to D of every row."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), digest.alias("digest"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array([own_bits(t.as_buffer().to_pybytes()) for t in batch.column("text")], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], bits], ["id", "part", "digest", "bits"])

    return rows.mapInArrow(run, "id long, part string, digest binary, bits int")


def cells(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Documents, good and toxic ones per part and failure bits.

    Both joined tables are stored first, so that Spark can split the rows of a text or id that very many rows share.
    """
    rows = stored(judged(docs, key=key, text=text, part=part), "audit-rows")
    firsts = stored(
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "audit-firsts")
    marks = stored(
        labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")),
        "audit-labels")
    bits = F.col("bits") + F.when(F.col("id") > F.col("first"), STATES >> 1).otherwise(0)
    told = rows.join(firsts, "digest", "left").select("id", "part", bits.alias("bits")).join(marks, "id", "left")
    return told.groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")])


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of each subset of filters, given what each cell counts (rows: cells by bits; columns: measures)."""
    active = np.zeros(STATES, np.int64)
    fails = (np.arange(STATES)[:, None] >> np.arange(len(FILTERS))) & 1
    states = np.zeros_like(counts)
    running, subset = counts.sum(axis=0), 0
    states[0] = running
    for step in range(1, STATES):
        toggled = (step & -step).bit_length() - 1
        subset ^= 1 << toggled
        hit = fails[:, toggled] == 1
        before = active[hit]
        active[hit] = before + (1 if subset >> toggled & 1 else -1)
        running = running - counts[hit][(before == 0)].sum(axis=0) + counts[hit][active[hit] == 0].sum(axis=0)
        states[subset] = running
    return states


def states(counted: DataFrame) -> DataFrame:
    """One row per part: for each measure, the survivors of all 32 subsets."""
    grouped = counted.groupBy("part").agg(F.collect_list(F.struct("bits", *COUNTED)).alias("cells"))  # at most 32 of them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            found = []
            for own in batch.column("cells").to_pylist():
                counts = np.zeros((STATES, len(COUNTED)), np.int64)
                for cell in own:
                    counts[cell["bits"]] = [cell[c] for c in COUNTED]
                found.append(walk(counts))
            columns = [pa.array([f[:, i].tolist() for f in found], kind) for i in range(len(COUNTED))]
            yield pa.RecordBatch.from_arrays([batch.column("part"), *columns], ["part", *COUNTED])

    return grouped.mapInArrow(run, "part string, " + ", ".join(f"{c} array<long>" for c in COUNTED))


def steps(stored_states: DataFrame) -> DataFrame:
    """Every step of every order of the filters, as differences of two stored states."""
    orders = F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order")
    each = stored_states.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda at: F.expr(f"shiftleft(1, ascii(substr(filter_order, {at}, 1)) - ascii('A'))")
    before = sum((F.when(F.col("step") > at, bit(at)).otherwise(0) for at in range(1, len(FILTERS))), F.lit(0))
    at = lambda measure, subset: F.get(measure, subset)
    b, f = F.col("before"), F.col("own")
    after = b.bitwiseOR(f)
    removed = lambda measure: at(measure, b) - at(measure, after)
    full = F.lit(STATES - 1)
    shapley = F.lit(0).cast("long")
    for s in range(STATES):
        # What the step's filter removes after subset ``s``, in as many orders as begin with ``s`` in front of it.
        drop = at("n", F.lit(s)) - at("n", F.lit(s).bitwiseOR(f))
        shapley = shapley + F.when(F.lit(s).bitwiseAND(f) == 0, drop * WEIGHTS[min(s.bit_count(), 4)]).otherwise(0)
    placed = each.select("*", before.alias("before"), bit("step").alias("own"))
    return placed.select(
        "part", "filter_order", "step", at("n", after).alias("kept"), removed("n").alias("removed"),
        (at("n", F.lit(0)) - at("n", f) - removed("n")).alias("redundant"),
        (at("n", full.bitwiseXOR(f)) - at("n", full)).alias("unique_fails"),
        removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order and step: what is kept, removed, redundant, failed by this filter only, and lost of good and toxic."""
    return steps(states(cells(docs, labels, key=key, text=text, part=part)))

"""Hard-negative mining over Hilbert-ordered blocks of vectors with zone maps.

Vectors become integers (``floor(256 * x)``) and are ordered along a Hilbert curve through their dimensions of largest variance.
``BLOCK`` neighbours on the curve are one row of a Parquet table: a matrix with the smallest and largest value of every dimension.
For an anchor, interval arithmetic over those ranges bounds every score in a block from below and above, so only blocks whose bounds
meet one of the anchor's windows of wanted scores are read; scores are then exact.

A search has two passes. The first reads the few most promising blocks per tile of anchors; the k-th best score found there raises the
lower end of a window. The second reads every other block that can still hold a better row. Positives are a search with one open
window (same label), negatives one with a window per positive (other labels). Nothing is cut off: a block is left out only if
no row of it can be among the first k.

Anchors meet blocks in tiles, a tile's copies are as many as the blocks it must read. All matrices are bounded by ``BLOCK``,
``TILE`` and ``PAGE``; hot labels or equal vectors only fill further blocks.

Defined results: rows with a null label or vector, or a null, NaN or infinite component, take no part. Shorter vectors count
as filled up with zeros. Components are clipped where scores could pass 55 bits. Repeated rows are rows of their own, as partners and
as anchors. A row without an id is no anchor and comes last among ties. Scores may be zero or negative; a negative positive has an empty
window. Further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

SCALE = 256
BLOCK = 1024  # rows of a block
TILE = 12  # blocks whose anchors form a tile
PAGE = 256  # blocks whose zone maps are read together
PROBE = 4  # blocks of a page that a tile reads first
SORTED = 65_536  # rows of a sorted part
CURVE_DIMS, CURVE_BITS = 8, 7
NO_ID = 2**63 - 1
LOW, HIGH = -(2**62), 2**62


def integers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """A row of ``dims`` clipped integers per vector."""
    lengths = np.diff(np.asarray(vectors.offsets))
    flat = np.asarray(vectors.flatten(), np.float64)
    most = math.isqrt(2**55 // max(1, dims)) if dims < 2**20 else 1
    whole = np.clip(np.floor(flat * scale), -min(most, 2**31 - 1), min(most, 2**31 - 1)).astype(np.int32)
    out = np.zeros((len(vectors), dims), np.int32)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    return out


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points with coordinates below ``2**bits`` (rows: points). At most 63 bits in all."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    if not n:
        return np.zeros(points.shape[0], np.int64)
    # Undo the curve's turns from the coarsest level on: a set bit mirrors the lower bits of the first axis, a clear one swaps them.
    for level in range(bits - 1, 0, -1):
        mask = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(turned, mask, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flips
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> level & 1)
    return place


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices, exact."""
    bound = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of each anchor (rows) with any vector of each zone (columns)."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return product(plus, low) + product(minus, high), product(plus, high) + product(minus, low)


def usable(rows: DataFrame, *, key: str, vector: str, label: str) -> DataFrame:
    kind = rows.schema[vector].dataType.simpleString()
    v = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    vectors = rows.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)


def moments(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows; per dimension, sum and sum of squares. Summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, np.zeros((2, 0))
        for batch in batches:
            v = batch.column("v")
            lengths, flat = np.diff(np.asarray(v.offsets)), np.asarray(v.flatten(), np.float64)
            dim = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            width = max(sums.shape[1], int(lengths.max(initial=0)))
            with np.errstate(over="ignore"):
                add = np.stack([np.bincount(dim, w, width) for w in (flat, flat * flat)])
            add[:, : sums.shape[1]] += sums
            rows, sums = rows + len(v), add
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, sums.shape[1])), pa.array([float(rows), *sums[0]]), pa.array([0.0, *sums[1]])], ["dim", "s", "ss"])

    parts = vectors.select("v").mapInArrow(run, "dim long, s double, ss double")
    found = parts.groupBy("dim").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("dim").collect()  # one row per dimension
    return int(found[0]["s"]) if found else 0, np.array([[r["s"], r["ss"]] for r in found[1:]]).reshape(-1, 2)


def placed(vectors: DataFrame, scale: int) -> tuple[DataFrame, int, int]:
    """The vectors as integers, numbered along the curve; the number of dimensions and of rows."""
    n, sums = moments(vectors)
    dims = len(sums)
    with np.errstate(all="ignore"):
        mean = np.nan_to_num(sums[:, 0] / max(1, n), posinf=0.0, neginf=0.0)
        spread = np.nan_to_num(np.sqrt(np.maximum(sums[:, 1] / max(1, n) - mean**2, 0)), nan=0.0, posinf=0.0)
    axes = np.sort(np.argsort(-spread, kind="stable")[:CURVE_DIMS])
    start, step = (mean - 3 * spread)[axes], np.maximum(6 * spread[axes], 1e-12) / (1 << CURVE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column("v"), dims, scale)
            grid = np.clip((whole[:, axes] / scale - start) / step, 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            packed = pa.array([r.tobytes() for r in whole], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), packed, pa.array(hilbert(grid, CURVE_BITS))], ["id", "label", "q", "curve"])

    # Equal vectors share a place on the curve; the id and a hash still tell them apart, so that they fill several parts.
    kinds = vectors.mapInArrow(run, "id long, label long, q binary, curve long").withColumn("h", F.xxhash64("q", "label"))
    ordered = kinds.repartitionByRange(max(1, -(-n // SORTED)), "curve", "id", "h").sortWithinPartitions("curve", "id", "h")
    rows = stored(ordered.select("id", "label", "q", F.monotonically_increasing_id().alias("at")), "vectors")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).count()
    offsets = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    numbered = rows.withColumn("part", part).join(offsets, "part")
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return numbered.select("id", "label", "q", place.alias("place")), dims, n


def blocks_of(rows: DataFrame, dims: int) -> DataFrame:
    """One row per block: ids, labels, matrix, and its zone map."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        q = np.frombuffer(b"".join(table["q"].to_pylist()), np.int32).reshape(len(table), dims)
        labels = np.asarray(table["label"], np.int64)
        one = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({
            "block": pa.array([table["place"][0].as_py() // BLOCK], pa.int64()), "ids": one(np.asarray(table["id"], np.int64)),
            "labels": one(labels), "q": one(q), "low": one(q.min(axis=0, initial=2**31 - 1)), "high": one(q.max(axis=0, initial=-(2**31))),
            "kinds": pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
        })

    return rows.withColumn("block", F.expr(f"place div {BLOCK}")).groupBy("block").applyInArrow(
        run, "block long, ids binary, labels binary, q binary, low binary, high binary, kinds array<long>")


def tiles_of(rows: DataFrame, every: int) -> DataFrame:
    """One row per tile: the anchors among the rows of neighbouring blocks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        one = lambda c: pa.array([np.asarray(table[c], np.int64).tobytes()], pa.binary())
        return pa.table({
            "tile": pa.array([table["place"][0].as_py() // (BLOCK * TILE)], pa.int64()), "a_ids": one("id"), "a_labels": one("label"),
            "a_places": one("place"), "a_q": pa.array([b"".join(table["q"].to_pylist())], pa.binary()),
        })

    anchors = rows.where((F.col("id") % every == 0) & (F.col("id") != NO_ID))
    return anchors.withColumn("tile", F.expr(f"place div {BLOCK * TILE}")).groupBy("tile").applyInArrow(
        run, "tile long, a_ids binary, a_labels binary, a_places binary, a_q binary")


def pages_of(blocks: DataFrame) -> DataFrame:
    """One row per page: the zone maps of neighbouring blocks."""

    def run(table: pa.Table) -> pa.Table:
        one = lambda c: pa.array([b"".join(table[c].to_pylist())], pa.binary())
        return pa.table({
            "page": pa.array([table["block"][0].as_py() // PAGE], pa.int64()), "lows": one("low"), "highs": one("high"),
            "numbers": pa.array([table["block"].to_pylist()], pa.list_(pa.int64())),
            "kinds": pa.array([table["kinds"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
        })

    zones = blocks.select("block", "low", "high", "kinds").withColumn("page", F.expr(f"block div {PAGE}"))
    return zones.groupBy("page").applyInArrow(
        run, "page long, lows binary, highs binary, numbers array<long>, kinds array<array<long>>")


def _ints(scalar: pa.Scalar, kind=np.int64) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), kind)


class Index:
    """Stored blocks, pages of their zone maps, and tiles of anchors."""

    def __init__(self, rows: DataFrame, *, key: str, vector: str, label: str, every: int, scale: int):
        placed_rows, self.dims, self.rows = placed(usable(rows, key=key, vector=vector, label=label), scale)
        self.blocks = stored(blocks_of(placed_rows, self.dims), "blocks")
        self.tiles = stored(tiles_of(placed_rows, every), "tiles")
        self.pages = stored(pages_of(self.blocks), "zones")
        self.n_pages = -(-self.rows // (BLOCK * PAGE))

    def wanted(self, windows: DataFrame, same: bool, probe: bool) -> DataFrame:
        """(tile, block) pairs to read: the most promising ones, or all that may hold a row of a window."""
        dims = self.dims

        def run(table: pa.Table) -> pa.Table:
            r = {c: table[c][0] for c in table.column_names}
            labels = _ints(r["a_labels"])
            anchors = _ints(r["a_q"], np.int32).reshape(len(labels), dims)
            numbers = np.array(r["numbers"].as_py(), np.int64)
            least, most = bounds(
                anchors, _ints(r["lows"], np.int32).reshape(-1, dims), _ints(r["highs"], np.int32).reshape(-1, dims))
            kinds = r["kinds"].as_py()
            fits = np.stack([np.isin(labels, k) if same else ~(np.isin(labels, k) & (len(k) == 1)) for k in kinds], axis=1)
            low, high = (_ints(r[c]).reshape(len(labels), -1) for c in ("w_low", "w_high"))
            meets = np.zeros_like(fits)
            for w in range(low.shape[1]):
                meets |= (most >= low[:, w : w + 1]) & (least <= high[:, w : w + 1]) & (low[:, w : w + 1] <= high[:, w : w + 1])
            fits &= meets
            if probe:
                votes = np.where(fits, most.astype(np.float64), -np.inf)
                order = np.argsort(-votes, axis=1, kind="stable")[:, :2]
                count = np.bincount(order.ravel(), np.take_along_axis(fits, order, 1).ravel(), len(numbers))
                chosen = np.argsort(-count, kind="stable")[:PROBE]
                read = chosen[count[chosen] > 0]
            else:
                read = np.flatnonzero(fits.any(axis=0))
            return pa.table({"tile": pa.array([r["tile"].as_py()] * len(read), pa.int64()), "block": pa.array(numbers[read], pa.int64())})

        asked = self.tiles.select("tile", "a_labels", "a_q").join(windows, "tile")
        each = asked.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, self.n_pages - 1)).cast("long"))))
        return each.join(self.pages, "page").groupBy("tile", "page").applyInArrow(run, "tile long, block long")

    def read(self, pairs: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """The first ``k`` rows of each window in each block that is read."""
        dims = self.dims

        def run(table: pa.Table) -> pa.Table:
            r = {c: table[c][0] for c in table.column_names}
            ids, labels, own = _ints(r["ids"]), _ints(r["labels"]), _ints(r["a_labels"])
            anchors = _ints(r["a_q"], np.int32).reshape(len(own), dims)
            scores = product(anchors, _ints(r["q"], np.int32).reshape(len(ids), dims))
            places = r["block"].as_py() * BLOCK + np.arange(len(ids))
            fits = (own[:, None] == labels) == same
            fits &= _ints(r["a_places"])[:, None] != places
            low, high = (_ints(r[c]).reshape(len(own), -1) for c in ("w_low", "w_high"))
            parts = []
            for w in range(low.shape[1]):
                inside = np.where(fits & (scores >= low[:, w : w + 1]) & (scores <= high[:, w : w + 1]), scores, LOW - 1)
                if len(ids) > k:  # no score below the k-th best of its anchor
                    inside[inside < np.partition(inside, len(ids) - k, axis=1)[:, len(ids) - k, None]] = LOW - 1
                a, at = np.nonzero(inside >= LOW)
                order = np.lexsort((places[at], ids[at], -inside[a, at], a))
                a, at = a[order], at[order]
                keep = np.arange(len(a)) - np.searchsorted(a, a) < k
                a, at = a[keep], at[keep]
                parts.append((a, np.full(len(a), w), _ints(r["a_ids"])[a], ids[at], places[at], scores[a, at]))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            return pa.table({
                "tile": pa.array(np.full(len(columns[0]), r["tile"].as_py())),
                **{c: pa.array(p, pa.int64()) for c, p in zip(("a", "w", "anchor", "id", "place", "score"), columns, strict=True)},
            })

        asked = pairs.join(self.tiles.join(windows, "tile"), "tile")
        met = asked.join(self.blocks.select("block", "ids", "labels", "q"), "block")
        return met.groupBy("tile", "block").applyInArrow(run, "tile long, a long, w long, anchor long, id long, place long, score long")

    def search(self, windows: DataFrame, *, same: bool, k: int, label: str) -> DataFrame:
        """The first ``k`` rows of every window, ranked by score, then id."""
        probes = stored(self.wanted(windows, same, True), f"{label}-probes")
        found = stored(first(self.read(probes, windows, same, k), k), f"{label}-probed")
        raised = stored(raise_windows(windows, found, k), f"{label}-windows")
        rest = self.wanted(raised, same, False).join(probes, ["tile", "block"], "left_anti")
        return stored(first(self.read(rest, raised, same, k).unionByName(found.drop("rank")), k), f"{label}-found")


def first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("tile", "a", "w").orderBy(F.desc("score"), "id", "place")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


WINDOWS = "tile long, n long, w_low binary, w_high binary"


def _windows(tile, low: np.ndarray, high: np.ndarray) -> pa.Table:
    one = lambda x: pa.array([x.astype(np.int64).tobytes()], pa.binary())
    return pa.table({"tile": tile, "n": pa.array([low.shape[1]], pa.int64()), "w_low": one(low), "w_high": one(high)})


def open_windows(tiles: DataFrame) -> DataFrame:
    """One window per anchor that takes every score."""

    def run(table: pa.Table) -> pa.Table:
        n = len(_ints(table["a_ids"][0]))
        return _windows(table["tile"], np.full((n, 1), LOW), np.full((n, 1), HIGH))

    return tiles.select("tile", "a_ids").groupBy("tile").applyInArrow(run, WINDOWS)


def raise_windows(windows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """No window needs a score below the ``k``-th best that is already found in it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high = (_ints(left[c][0]).reshape(-1, left["n"][0].as_py()) for c in ("w_low", "w_high"))
        low = low.copy()
        low[np.asarray(right["a"]), np.asarray(right["w"])] = np.asarray(right["score"])
        return _windows(left["tile"], low, high)

    last = found.where(F.col("rank") == k).select("tile", "a", "w", "score")
    return windows.groupBy("tile").cogroup(last.groupBy("tile")).applyInArrow(run, WINDOWS)


def windows_below(tiles: DataFrame, positives: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """A window per anchor and positive: from ``least`` to ``most`` hundredths of the positive's score. None is the empty window."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = len(_ints(left["a_ids"][0]))
        low, high = np.ones((n, k), np.int64), np.zeros((n, k), np.int64)
        a, w, score = (np.asarray(right[c], np.int64) for c in ("a", "rank", "score"))
        low[a, w - 1] = -((-least * score) // 100)
        high[a, w - 1] = (most * score) // 100
        return _windows(left["tile"], low, high)

    scores = positives.select("tile", "a", "rank", "score")
    return tiles.select("tile", "a_ids").groupBy("tile").cogroup(scores.groupBy("tile")).applyInArrow(run, WINDOWS)


def mine(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50, positives: int = 5,
         negatives: int = 3, least: int = 50, most: int = 95, scale: int = SCALE) -> DataFrame:
    """Anchors (ids divisible by ``every``), their first ``positives`` rows of the same label, and for each of those the first
    ``negatives`` rows of other labels whose score lies between ``least`` and ``most`` hundredths of the positive's."""
    index = Index(rows, key=key, vector=vector, label=label, every=every, scale=scale)
    near = index.search(open_windows(index.tiles), same=True, k=positives, label="positives")
    windows = stored(windows_below(index.tiles, near, positives, least, most), "windows")
    hard = index.search(windows, same=False, k=negatives, label="negatives")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    pos = near.select(
        "tile", "a", (F.col("rank") - 1).cast("long").alias("w"), known("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(pos, ["tile", "a", "w"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", known("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

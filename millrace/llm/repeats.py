"""Removal of byte strings that stand earlier in the corpus, by threshold-bounded interval expansion on a BWT.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a document of smaller id, or earlier in
the same document.

1. *Anchors.* Of the 32-byte grams inside each string of 100 bytes, the one of smallest hash is its anchor, so equal strings have
   equal anchors. Neighbouring strings with one anchor form a fragment. Texts do not move: per fragment, two hashes and its place do.
2. *Equal fragments* are folded, first within a batch and then by a shuffle on the anchor; all but the earliest repeat
   it in whole. Anchors with one fragment hold no further repeat.
3. *Different fragments of one anchor* share some strings at most. They are cut from the texts and dealt to buckets by anchor. In each bucket
   a Burrows-Wheeler transform of the fragments is built and its intervals are expanded backward, breadth first: step ``l``
   finds all places where neighbouring suffixes part after ``l`` bytes. After ``LENGTH`` steps the expansion stops, and what has
   not been parted are the groups of equal strings; each keeps its earliest member.
4. The runs of repeated strings of each document are joined to its text.

An anchor that stands in very many contexts (``ANCHOR_BYTES``) is thinned before it goes to a bucket (``thinned``): strings that occur
once are sieved out by a hash of each string, repeated ones of one batch are folded, and so are equal runs of what remains. The
sieve only leaves out what has no equal; the transform compares the rest. Should an anchor still be too large, its strings are
grouped by their bytes, with partial aggregation and a join that Spark can split. So no group has to fit a task's memory.

Defined results: a null text is empty; a text below ``LENGTH`` bytes loses nothing; rows that repeat id and text are one
document, and each gets its result; rows of one id with different texts are ordered by a hash of the text; a null id precedes all others;
further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

LENGTH = 100
GRAM = 32
SEGMENT = 256 << 10
BUCKET_BYTES = 512 << 10
ANCHOR_BYTES = 4 << 20
SEPARATOR = 0xFF  # not a byte of UTF-8

_MIX = np.random.default_rng(100)
_BYTES = _MIX.integers(0, 2**64, 256, dtype=np.uint64)
_ODD = _MIX.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)
_SHIFT = np.uint64(29)


# ---------------------------------------------------------------- anchors and fragments

def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32 and of the 64 bytes from each place on."""
    x, y, shifted, done, short = _BYTES.take(data), np.empty(len(data), np.uint64), np.empty(len(data), np.uint64), 1, None
    for odd in _ODD[:6]:
        n = len(x) - done
        np.multiply(x[:n], odd, out=y[:n])
        y[:n] += x[done:]
        np.right_shift(y[:n], _SHIFT, out=shifted[:n])
        y[:n] ^= shifted[:n]
        x, y, done = y[:n], x[:n], 2 * done
        if done == GRAM:
            short = x.copy()
    return short, x


def fragments(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, first start, last start) of all fragments in the segments ``begin`` to ``end`` of a buffer."""
    short, long = grams(data)
    least = short & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(short), dtype=np.uint64)
    width, reach, spare = LENGTH - GRAM + 1, 1, np.empty_like(least)
    while 2 * reach <= width:
        n = len(least) - reach
        np.minimum(least[:n], least[reach:], out=spare[:n])
        least, spare, reach = spare[:n], least, 2 * reach
    over = width - reach
    least = np.minimum(least[: len(least) - over], least[over:])
    size = end - begin - LENGTH + 1
    starts = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    lo, hi = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    content = long[lo] * _ODD[6]
    content ^= content >> _SHIFT
    content += long[(lo + hi + LENGTH - 64) // 2]
    content *= _ODD[7]
    content ^= content >> _SHIFT
    content += long[hi + LENGTH - 64] + (hi - lo).astype(np.uint64) * _ODD[6]
    return short[anchor[first]], content, lo, hi


def runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts, put together where one follows on another in its document."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)])) if len(doc) else np.zeros(0, int)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    return doc[first], lo[first], hi[last]


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per fragment (``again`` false), or per run of repeats already seen in the batch (``again`` true)."""
    kind = docs.schema["id"].dataType.simpleString()

    def ranks(ids: list, hashes: list) -> np.ndarray:
        """Number of each document in the order of the corpus; repeated rows share one."""
        keys = [(i is not None, i if i is not None else 0, h) for i, h in zip(ids, hashes, strict=True)]
        number = {k: n for n, k in enumerate(sorted(set(keys)))}
        return np.array([number[k] for k in keys], np.int64)

    def of_part(rows: list[tuple], texts: list[bytes], rank: np.ndarray, salt: int) -> tuple:
        """Columns of a part, given as segments (row, from, to)."""
        row = np.array([r for r, _, _ in rows])
        offset = np.array([a for _, a, _ in rows])
        lengths = np.array([b - a for _, a, b in rows])
        end = np.cumsum(lengths)
        data = np.frombuffer(b"".join([texts[r][a:b] for r, a, b in rows]), np.uint8)
        anchor, content, lo, hi = fragments(data, end - lengths, end)
        seg = np.searchsorted(end, lo, side="right")
        shift = offset[seg] - (end - lengths)[seg]
        of, lo, hi = row[seg], lo + shift, hi + shift
        order = np.lexsort((lo, rank[of], content, anchor))
        same = np.concatenate([[False], (anchor[order][1:] == anchor[order][:-1]) & (content[order][1:] == content[order][:-1])])
        later = np.zeros(len(order), bool)
        later[order[same]] = True
        if same.any():  # a repeated row is not later than itself
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            twin = (rank[of[order]] == rank[of[order[head]]]) & (lo[order] == lo[order[head]])
            later[order[same & twin]] = False
        d, l, h = runs(of[later], lo[later], hi[later])
        fresh = ~later
        unique = (d.astype(np.uint64) << np.uint64(32)) + l.astype(np.uint64)
        unique = (unique + np.uint64(salt & 0xFFFFFFFF)) * _ODD[5]
        unique ^= unique >> _SHIFT
        docs_of = np.concatenate([of[fresh], d])
        return (
            np.concatenate([anchor[fresh], unique * _ODD[4]]).view(np.int64), np.concatenate([content[fresh], unique]).view(np.int64),
            docs_of, np.concatenate([lo[fresh], l]), np.concatenate([hi[fresh] - lo[fresh], h - l]) + LENGTH,
            np.concatenate([np.zeros(fresh.sum(), bool), np.ones(len(d), bool)]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("id").to_pylist(), batch.column("h").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            parts, filled = [[]], 0
            for r, text in enumerate(texts):
                for a in range(0, len(text) - LENGTH + 1, SEGMENT):
                    b = min(len(text), a + SEGMENT + LENGTH - 1)
                    if filled and filled + b - a > SEGMENT:
                        parts.append([])
                        filled = 0
                    parts[-1].append((r, a, b))
                    filled += b - a
            rank = ranks(ids, hashes)
            for rows in filter(None, parts):
                anchor, content, of, lo, size, again = of_part(rows, texts, rank, hashes[rows[0][0]] + rows[0][1])
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), batch.column("id").take(take), batch.column("h").take(take),
                     pa.array(lo.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(again)],
                    ["anchor", "content", "id", "h", "lo", "size", "again"])

    return docs.mapInArrow(run, f"anchor long, content long, id {kind}, h long, lo int, size int, again boolean")


# ---------------------------------------------------------------- interval expansion

def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their next ``depth`` bytes or more, by prefix doubling from eight bytes on."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    reach = 8
    while True:
        order = np.argsort(key)
        if reach >= depth:
            return order
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        key = rank * np.uint64(n + 1)
        key[: n - reach] += rank[reach:]
        reach *= 2


def equal_strings(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in suffix order, group of each): places are grouped by their next ``length`` bytes.

    The groups come from the transform alone. All intervals of strings of ``l`` bytes are known by their left borders. The
    interval of ``c`` before such a string holds the ``c`` of the transform inside it, moved to where ``c`` sorts; a new
    border lies wherever two neighbours among these come from different intervals. Only ``length`` steps are taken.
    """
    order = suffix_order(data, length)
    transform = data[order - 1]
    moved = np.argsort(transform, kind="stable")
    heads = transform[moved]
    border = np.concatenate([[True], heads[1:] != heads[:-1]])  # strings of one byte
    first = border.copy()
    for _ in range(length - 1):
        interval = np.cumsum(border, dtype=np.int32)[moved]
        grown = first.copy()
        grown[1:] |= interval[1:] != interval[:-1]
        border = grown
    return order, np.cumsum(border, dtype=np.int64)


def repeats_of_bucket(bucket: pa.Table) -> pa.Table:
    """Runs of strings of a bucket's fragments that start earlier in another place."""
    ids, hashes, lo = bucket["id"].to_pylist(), bucket["h"].to_pylist(), bucket["lo"].to_numpy()
    parts = bucket["bytes"].to_pylist()
    names = sorted({(i is not None, i if i is not None else 0, h) for i, h in zip(ids, hashes, strict=True)})
    number = {n: k for k, n in enumerate(names)}
    doc = np.array([number[i is not None, i if i is not None else 0, h] for i, h in zip(ids, hashes, strict=True)], np.int64)
    data = np.frombuffer(b"".join([p + b"\xff" for p in parts]), np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(sizes) - sizes
    order, group = equal_strings(data, LENGTH)
    part = np.searchsorted(begin, order, side="right") - 1
    inside = order - begin[part]
    valid = inside <= sizes[part] - 1 - LENGTH
    part, inside, group = part[valid], inside[valid], group[valid]
    at = (doc[part] << 32) + lo[part] + inside
    by = np.lexsort((at, group))
    at, group = at[by], group[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(len(at)), 0)) if len(at) else at
    later = np.unique(at[at > at[head]])
    d, first, last = runs(later >> 32, later & 0xFFFFFFFF, later & 0xFFFFFFFF)
    return pa.table({
        "id": pa.array([names[k][1] if names[k][0] else None for k in d], bucket["id"].type),
        "h": pa.array([names[k][2] for k in d], pa.int64()),
        "lo": pa.array(first.astype(np.int32)), "size": pa.array((last - first + LENGTH).astype(np.int32)),
    })


# ---------------------------------------------------------------- the whole job

def _same(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])


def keys_of_strings(long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash per string of ``LENGTH`` bytes, from the hashes of its first and last 64."""
    key = long[at] * _ODD[6]
    key ^= key >> _SHIFT
    key += long[at + LENGTH - 64]
    key *= _ODD[7]
    return key ^ (key >> _SHIFT)


def strings_of(cut: DataFrame) -> DataFrame:
    """One row per string of the fragments: key, anchor and place; ``size`` is 0. Strings that a batch has had already, compared byte
    by byte, come as runs to remove instead, with their ``size``."""
    kind = cut.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("bytes").to_pylist()
            if not parts:
                continue
            names = [(i is not None, i if i is not None else 0, h)
                     for i, h in zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), strict=True)]
            number = {n: k for k, n in enumerate(sorted(set(names)))}
            doc = np.array([number[n] for n in names], np.int64)
            row_of = np.zeros(len(number), np.int64)
            row_of[doc] = np.arange(len(doc))
            data = np.frombuffer(b"".join(parts), np.uint8)
            sizes = np.array([len(p) for p in parts])
            begin, counts = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
            of = np.repeat(np.arange(len(parts)), counts)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            at, lo = begin[of] + inside, batch.column("lo").to_numpy()[of] + inside
            key = keys_of_strings(grams(data)[1], at)
            order = np.lexsort((lo, doc[of], key))
            same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            later = order[same]
            if len(later):
                text = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
                head = head[same]
                equal = (doc[of[later]] != doc[of[head]]) | (lo[later] != lo[head])  # a repeated row is not later than itself
                for a in range(0, len(later), 1 << 16):  # 6.5 MB at a time
                    b = slice(a, a + (1 << 16))
                    equal[b] &= (text[at[later[b]]] == text[at[head[b]]]).all(axis=1)
                later = later[equal]
            fresh = np.ones(len(of), bool)
            fresh[later] = False
            d, first, last = runs(doc[of[later]], lo[later], lo[later])
            rows = np.concatenate([of[fresh], row_of[d]])
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([key[fresh].view(np.int64), np.zeros(len(d), np.int64)])), batch.column("anchor").take(take),
                batch.column("id").take(take), batch.column("h").take(take), pa.array(np.concatenate([lo[fresh], first]).astype(np.int32)),
                pa.array(np.concatenate([np.zeros(fresh.sum(), np.int64), last - first + LENGTH]).astype(np.int32)),
            ], ["x", "anchor", "id", "h", "lo", "size"])

    return cut.mapInArrow(run, f"x long, anchor long, id {kind}, h long, lo int, size int")


def thinned(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs to remove, and the fragments of large anchors that still have to be compared, as ``anchor, id, h, lo, size``."""
    strings = stored(strings_of(cut), "strings")
    single = strings.where("size = 0").drop("size")
    keys = stored(single.groupBy("x").count().where("count > 1").select("x"), "repeated-strings")
    often = single.join(keys, "x")
    place = F.row_number().over(Window.partitionBy("id", "h", "anchor").orderBy("lo"))
    parts = often.distinct().withColumn("run", F.col("lo") - place).groupBy("id", "h", "anchor", "run").agg(
        F.min("lo").alias("lo"), (F.max("lo") - F.min("lo") + LENGTH).cast("int").alias("size"),
        F.min_by("x", "lo").alias("head"), F.max_by("x", "lo").alias("tail")).drop("run")
    # A run of strings with one anchor has at most 168 bytes, which its first and last string cover.
    parts = stored(parts, "repeated-runs")
    run = ["anchor", "head", "tail", "size"]
    firsts = stored(parts.groupBy(run).agg(F.min(F.struct("id", "h", "lo")).alias("first"), F.count(F.lit(1)).alias("n")), "first-runs")
    first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")) & (F.col("lo") == F.col("first.lo"))
    later = parts.join(firsts.where("n > 1"), run).where(~first).select("id", "h", "lo", "size")
    again = strings.where("size > 0").select("id", "h", "lo", "size").unionByName(later)
    return again, firsts.select("anchor", "first.*", "size")


def by_bytes(cut: DataFrame) -> DataFrame:
    """Runs of strings of ``cut`` that start earlier in another place, by partial aggregation and a join that can be split."""
    starts = F.expr(f"transform(sequence(1, length(bytes) - {LENGTH - 1}), s -> struct(lo + s - 1 as lo, substring(bytes, s, {LENGTH}) as x))")
    strings = cut.select("id", "h", F.explode(starts).alias("p")).select("id", "h", "p.lo", "p.x")
    firsts = strings.groupBy("x").agg(F.min(F.struct("id", "h", "lo")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stored(firsts.select("x", "first"), "first-strings")
    first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")) & (F.col("lo") == F.col("first.lo"))
    later = strings.join(firsts, "x").where(~first).select("id", "h", "lo").distinct()
    run = F.col("lo") - F.row_number().over(Window.partitionBy("id", "h").orderBy("lo"))
    return later.withColumn("run", run).groupBy("id", "h", "run").agg(
        F.min("lo").alias("lo"), (F.max("lo") - F.min("lo") + LENGTH).cast("int").alias("size")).select("id", "h", "lo", "size")


def spans(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """``id``, ``h``, ``lo``, ``size`` of byte runs to remove; ``docs`` has ``id``, ``h`` and ``text``."""
    of_anchor, of_content = Window.partitionBy("anchor"), Window.partitionBy("anchor", "content").orderBy("id", "h", "lo")
    found = occurrences(docs).withColumn("nth", F.rank().over(of_content)).withColumn(
        "many", F.min("content").over(of_anchor) != F.max("content").over(of_anchor))
    kept = stored(found.where("again or nth > 1 or many").select(
        "anchor", "id", "h", "lo", "size", (F.col("again") | (F.col("nth") > 1)).alias("again")), "fragments")
    rest = kept.where("not again").select("anchor", "id", "h", "lo", "size").distinct()

    def cut(parts: DataFrame) -> DataFrame:
        places = parts.groupBy("id", "h").agg(F.collect_list(F.struct("anchor", "lo", "size")).alias("parts"))
        return docs.join(places, _same(docs, places)).select(docs["id"], docs["h"], F.explode(F.expr(
            "transform(parts, p -> struct(p.anchor as anchor, p.lo as lo, substring(cast(text as binary), p.lo + 1, p.size) as bytes))"
        )).alias("p")).select("id", "h", "p.anchor", "p.lo", "p.bytes")

    def larger(parts: DataFrame, label: str) -> DataFrame:
        sums = parts.groupBy("anchor").agg(F.sum("size").alias("n"))
        return stored(sums.where(F.col("n") > anchor_bytes).select("anchor"), label)

    again = kept.where("again").select("id", "h", "lo", "size")
    large = larger(rest, "large-anchors")
    if not large.isEmpty():
        gone, few = thinned(cut(rest.join(large, "anchor", "left_semi")))
        again = again.unionByName(gone)
        still = larger(few, "largest-anchors")
        if not still.isEmpty():
            again = again.unionByName(by_bytes(cut(few.join(still, "anchor", "left_semi"))))
            few = few.join(still, "anchor", "left_anti")
        rest = rest.join(large, "anchor", "left_anti").unionByName(few)
    total = rest.agg(F.sum("size")).first()[0] or 0
    n_buckets = max(64, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(n_buckets))
    kind = docs.schema["id"].dataType.simpleString()

    def expand(bucket):
        return repeats_of_bucket(bucket)

    partly = cut(rest).groupBy(bucket.alias("bucket")).applyInArrow(expand, f"id {kind}, h long, lo int, size int")
    return again.unionByName(partly)


def clean(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: bytes, removed bytes and runs, hash of what is kept, and the kept bytes if asked for."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("h"), "text")
    gone = spans(rows).groupBy("id", "h").agg(F.collect_list(F.struct("lo", "size")).alias("gone"))
    joined = rows.join(gone, _same(rows, gone), "left").select(rows["id"], "text", "gone")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, n_spans, digest, left = [], [], [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                data, kept, at, n = text.encode(), [], 0, 0
                for lo, hi in sorted((g["lo"], g["lo"] + g["size"]) for g in gone or ()):
                    if n == 0 or lo > at:
                        kept.append(data[at:lo])
                        n += 1
                    at = max(at, hi)
                kept.append(data[at:])
                rest = b"".join(kept)
                n_bytes.append(len(data))
                removed.append(len(data) - len(rest))
                n_spans.append(n)
                digest.append(hashlib.sha256(rest).hexdigest())
                left.append(rest if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(v, pa.int64()) for v in (n_bytes, removed, n_spans)], pa.array(digest, pa.string()),
                 pa.array(left, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    done = done.withColumnRenamed("id", key)
    return done if keep_text else done.drop("kept")

"""N-gram Jaccard join by MinHash banding, with every candidate verified on its full n-gram sets.

1. Each text is read as words in lower case; texts with the same words are one *node*. Its five-word shingles give a MinHash
   signature, cut into bands. Bands and rows follow from the threshold and the recall asked for at it.
2. Nodes that share a band meet in a bucket, whose smallest node is its leader. All nodes with one leader form a group, so
   a pair that shares buckets many times is mostly in one group, and the candidates are as many rows as nodes, not pairs.
3. Groups are cut into blocks of ``BLOCK`` nodes, and each two blocks are compared in one task: products of their shingle
   incidence matrices give all intersections at once, on the full sets. A pair with several common leaders counts in the group
   of the smallest. A task gives out the number of links of its nodes and a spanning forest of them, never the pairs.
4. Classes are the connected components of the links, by label propagation with pointer jumping.

Defined results: a text without words (null, empty, signs only) is a class of its own; a text of fewer than five words has its
words as its one shingle; rows that repeat are in one class; ``class_id`` is the smallest id of the class (null if all are null);
further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.worker import kept
from millrace.session import stored

SHINGLE = 5
SIMILAR = 0.8
RECALL = 0.9995
HASHES_MOST = 128
KEPT_WORDS = 300_000
BLOCK = 1024
COLUMNS = 4096
WORD = re.compile(r"\w+")

_FACTORS = np.random.default_rng(5).integers(0, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)


def bands_for(similar: float = SIMILAR, recall: float = RECALL, most: int = HASHES_MOST) -> tuple[int, int]:
    """(bands, rows): the most rows per band with which pairs at the threshold are found with the recall asked for."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similar**rows))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall")
    return best


class Codes(dict):
    """64-bit codes of words, remembered per worker."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        code = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return code


def shingles(words: list[str]) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of five words."""
    code = kept("word-codes", Codes).__getitem__
    codes = np.fromiter(map(code, words), np.uint64, len(words))
    n = max(1, len(codes) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(codes))):
        out += codes[k : k + n] * _FACTORS[k]
    out ^= out >> np.uint64(31)
    out *= _FACTORS[0]
    out ^= out >> np.uint64(29)
    return np.unique(out)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 80):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.times = draw.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.plus = draw.integers(0, 2**64, bands * rows, dtype=np.uint64)
        self.fold = draw.integers(0, 2**64, rows, dtype=np.uint64) | np.uint64(1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """One 64-bit value per band."""
        least = np.full(len(self.times), 2**64 - 1, np.uint64)
        for at in range(0, len(hashes), 1024):
            np.minimum(least, (hashes[at : at + 1024, None] * self.times + self.plus).min(axis=0), out=least)
        least ^= least >> np.uint64(32)
        return (least.reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=np.uint64)


def signatures(docs: DataFrame, hasher: MinHash) -> DataFrame:
    """``id``, ``h`` (hash of the text), ``node`` (hash of the words; null without words) and ``bands``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, bands = [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                nodes.append(hashlib.blake2b("\n".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest() if words else None)
                bands.append(hasher.of(shingles(words)).view(np.int64) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("h"), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "h", "node", "bands"])

    return docs.mapInArrow(run, f"id {kind}, h long, node binary, bands array<long>")


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of the sets numbered ``left`` (rows) and ``right`` (columns)."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(often > 1) - 1  # a shingle of one set is in no common part
    use = often[column] > 1
    of, column = of[use], rank[column[use]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(rank[-1]) + 1, COLUMNS):
        part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
        present = np.zeros((len(sets), COLUMNS), np.float32)
        present[of[part], column[part] - at] = 1
        common += present[left] @ present[right].T
    return common


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(node, root) pairs that connect what the matrix links."""
    both = np.zeros((n, n), bool)
    both[np.ix_(left, right)] = linked
    both |= both.T
    open_, out = both.any(axis=1), []
    while open_.any():
        root = int(np.argmax(open_))
        seen = np.zeros(n, bool)
        edge = np.zeros(n, bool)
        edge[root] = True
        while edge.any():
            seen |= edge
            edge = both[edge].any(axis=0) & ~seen
        open_ &= ~seen
        out += [(int(v), root) for v in np.flatnonzero(seen) if v != root]
    return out


def verifier(similar: float):
    """Compare two blocks of a group, or one with itself."""

    def run(key, group):
        leader, one, other = (k.as_py() for k in key)
        nodes, blocks = group["node"].to_pylist(), group["block"].to_numpy()
        sets = [shingles(words_of(t)) for t in group["text"].to_pylist()]
        left, right = np.flatnonzero(blocks == one), np.flatnonzero(blocks == other)
        size = np.array([len(x) for x in sets], np.float64)
        common = intersections(sets, left, right).astype(np.float64)
        linked = common / (size[left][:, None] + size[right] - common) >= similar - 1e-12
        if one == other:
            linked &= left[:, None] < right
        # Pairs that also have a smaller leader in common count there.
        before = [[x for x in xs if x < leader] for xs in group["leaders"].to_pylist()]
        number = {x: k for k, x in enumerate(sorted({x for xs in before for x in xs}))}
        if number:
            has = np.zeros((len(nodes), len(number)), np.float32)
            for r, xs in enumerate(before):
                has[r, [number[x] for x in xs]] = 1
            linked &= has[left] @ has[right].T == 0
        degree = np.bincount(left, linked.sum(axis=1), len(nodes)) + np.bincount(right, linked.sum(axis=0), len(nodes))
        some = np.flatnonzero(degree)
        tied = forest(linked, left, right, len(nodes))
        return pa.table({
            "a": pa.array([nodes[k] for k in some] + [nodes[v] for v, _ in tied], pa.binary()),
            "b": pa.array([None] * len(some) + [nodes[r] for _, r in tied], pa.binary()),
            "n": pa.array([int(degree[k]) for k in some] + [0] * len(tied), pa.int64()),
        })

    return run


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of every linked node."""
    both = stored(links.select("a", "b").union(links.select("b", "a")), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        hop = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("to"))
        far = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        jumped = hop.join(far, hop["to"] == far["via"], "left").select(
            "node", F.least("to", F.coalesce("far", "to")).alias("root"), F.col("root").alias("was"))
        step = stored(jumped, "labels")
        labels = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return labels


def classes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", similar: float = SIMILAR, recall: float = RECALL,
) -> DataFrame:
    """Per row: ``id``, ``h``, ``class_id``, ``first_h`` (with ``class_id`` the class's first row), ``n_links``, ``n_copies``."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("h"), "text")
    signed = stored(signatures(rows, MinHash(*bands_for(similar, recall))), "signatures")
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "h")).alias("at"), F.first("bands").alias("bands"), (F.count(F.lit(1)) - 1).alias("n_copies"))

    banded = nodes.select("node", F.posexplode("bands").alias("k", "v")).select("node", F.xxhash64("k", "v").alias("bucket"))
    least = banded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    met = banded.join(least, "bucket").select("node", F.xxhash64("leader").alias("leader"))
    groups = stored(met.groupBy("node").agg(F.collect_set("leader").alias("leaders")), "groups")

    where = nodes.select("node", "at.id", "at.h").join(groups, "node")
    texts = rows.join(where, rows["id"].eqNullSafe(where["id"]) & (rows["h"] == where["h"])).select(
        "node", "leaders", "text").dropDuplicates(["node"])
    each = stored(texts, "near-texts").select("node", "leaders", "text", F.explode("leaders").alias("leader"))
    blocks = groups.select(F.explode("leaders").alias("leader")).groupBy("leader").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    dealt = each.join(blocks, "leader").withColumn("block", mine).withColumn("with", F.explode(F.expr("sequence(0, n_blocks - 1)")))
    paired = dealt.select("leader", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
                          "block", "node", "leaders", "text")
    found = stored(paired.groupBy("leader", "one", "other").applyInArrow(verifier(similar), "a binary, b binary, n long"), "verified")
    links = found.where("b is not null").select("a", "b")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    # Everything is settled per node first. What many rows share, a class or a text, is then joined from a stored table, so
    # that Spark can split a large one.
    settled = stored(nodes.select("node", "at", "n_copies").join(components(links), "node", "left").join(degree, "node", "left").select(
        "node", "at", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "node").alias("class")), "settled")
    heads = stored(settled.groupBy("class").agg(F.min("at").alias("head")), "heads")
    told = stored(settled.join(heads, "class").select("node", "head", "n_links", "n_copies"), "told")
    worded = signed.where("node is not null").select("id", "h", "node").join(told, "node").select(
        "id", "h", F.col("head.id").alias("class_id"), F.col("head.h").alias("first_h"), "n_links", "n_copies")
    # A row without words is a class of its own.
    none = F.lit(0).cast("long")
    wordless = signed.where("node is null").select(
        "id", "h", F.col("id").alias("class_id"), F.col("h").alias("first_h"), none.alias("n_links"), none.alias("n_copies"))
    return worded.unionAll(wordless)

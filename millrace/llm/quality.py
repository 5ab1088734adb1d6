"""Rule bitmask ledger: measure and judge every document once, apply policies and ablations to the bits.

``ledger`` computes all measurements in one pass over the texts and sets one bit per failed rule. A policy is a
named, versioned set of rules, hence a mask: changing it, or asking what each of its rules costs, needs no text.

Defined results: a null text is an empty one; an empty text has no words and fails ``few_words``; rows are judged one by
one, so repeated rows repeat their result; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 8

# Each rule: its bit, and when a document fails it. Bits are never reused.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 20"),
    "repeated_windows": (1, "100 * n_repeat_words > 30 * n_words"),
    "many_symbols": (2, "5 * n_symbols > 4 * n_words"),
    "duplicate_lines": (3, "n_lines >= 4 and 10 * n_dup_lines > 5 * n_lines"),
    "short_words": (4, "word_chars < 2 * n_words"),
    "long_words": (5, "word_chars > 25 * n_words"),
    "few_letters": (6, "10 * n_letters < 4 * word_chars"),
}
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "v1-base": BASE,
    "v2-strict": tuple(RULES),
}
CURRENT = "v2-strict"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters")
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_NO_LETTERS = re.compile(r"[\W\d_]+")
_FACTORS = np.random.default_rng(8).integers(0, 2**64, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words which occurs twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows += codes[k : k + n] * _FACTORS[k]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    often = np.zeros(n, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int32)
    edges[:n] += often
    edges[WINDOW:] -= often
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(_NO_LETTERS.sub("", text)),
    )


def ledger(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements and ``failed_bits`` of every document."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [measure(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*values, strict=True)) if values else [[] for _ in MEASURES]
            arrays = [batch.column("key"), *[pa.array(c, pa.int64()) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, ["key", *MEASURES])

    measured = rows.mapInArrow(run, ", ".join([f"key {kind}", *[f"{m} long" for m in MEASURES]]))
    bits = sum((F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0) for bit, rule in RULES.values()), F.lit(0))
    return measured.withColumn("failed_bits", bits.cast("long")).withColumnRenamed("key", key)


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[name][0] for name in rules)


def keeps(policy: str = CURRENT):
    """Whether a ledger row passes a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For every rule of a policy: documents that fail it, and those that only it removes.

    The ledger is first counted per bit pattern, so what follows is as small as the set of patterns.
    """
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))).alias("bits")).count()
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << RULES[name][0]).cast("long").alias("bit")) for name in POLICIES[policy]
    ]))
    each = patterns.select("bits", "count", rules.alias("r")).select("bits", "count", "r.rule", "r.bit")
    hit = F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("count")).otherwise(0)
    alone = F.when(F.col("bits") == F.col("bit"), F.col("count")).otherwise(0)
    return each.groupBy("rule").agg(F.sum(hit).alias("failed"), F.sum(alone).alias("failed_alone"))

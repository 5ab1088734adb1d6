"""Benchmark decontamination by template canonicalisation, on built-in functions only.

Numbers, names and units become typed placeholders, so a question asked again with other values keeps its template. Windows of
``WINDOW`` words of the benchmark, as they are and canonical, are hash-joined with all windows of all documents. Shared windows of one
shift are a run. Slots are compared where the windows of a run stand, each by its own shift: a value of the item must always have become the
same value, inside a run and among the runs put together, which are those no further apart than ``REACH`` lengths of the item, nearest
first. Windows that are equal word for word need no slot test: all of them, of whatever run, always go together. If the windows put
together are enough of the item, the document holds it, word for word or with other parameters.

An item of fewer than ``WINDOW`` words, but at least ``SHORT``, is one window of its own length and is looked for word for word.

Names are capitalised words that do not begin a sentence; units count behind a number. A benchmark window needs ``LITERAL``
words that are no placeholders to be looked for as a template, with fewer it is looked for word for word only; a run without any such word
does not count, so runs of numbers do not match each other. The share is the larger of two: of all windows those found word for word, of
the windows with enough such words those found either way.

Defined results: a null text is empty; items below ``SHORT`` words and documents without a word share nothing; rows that repeat id and text are
one document; of repeated items each counts; further columns are not read; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

WINDOW = 8
LITERAL = 5
SHORT = 3
SHARE = 0.4
REACH = 4
BROADCAST_WINDOWS = 1_000_000  # 24 bytes each

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec min h hr hrs day days week weeks month months year years hour hours "
    "minute minutes second seconds meter meters metre metres mile miles gram grams kilogram kilograms pound pounds liter "
    "liters litre litres dollar dollars euro euros cent cents percent degree degrees inch inches foot feet kmh mph"
).split()
NAME, NUMBER, UNIT = "\ue002", "\ue001", "\ue003"  # private-use characters


def tokens(text: Column) -> Column:
    """Words in lower case; a name has a mark in front."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[\p{L}\p{N},;)] )\p{Lu}(?=\p{Ll})", NAME + "$0")
    return F.split(F.lower(marked), "[^\\p{L}\\p{N}" + NAME + "]+")


def canonical(words: str) -> Column:
    """The words with placeholders for names, numbers and units behind numbers."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    number = lambda w: f"({w} >= '0' and {w} < ':')"
    return F.expr(
        f"transform({words}, (w, i) -> case when {number('w')} then '{NUMBER}' when startswith(w, '{NAME}') then '{NAME}' "
        f"when i > 0 and w in ({units}) and {number(f'{words}[i - 1]')} then '{UNIT}' else w end)")


def windows(canon: str, length: int = WINDOW) -> Column:
    """Hash of each run of ``length`` words."""
    return F.expr(
        f"if(size({canon}) < {length}, array(), transform(sequence(1, size({canon}) - {length - 1}), i -> xxhash64(slice({canon}, i, {length}))))"
    ).cast("array<bigint>")


def is_slot(word: str) -> str:
    return f"{word} in ('{NAME}', '{NUMBER}', '{UNIT}')"


def plain(words: str | Column) -> Column:
    """The words without the marks of names."""
    return F.transform(words, lambda w: F.replace(w, F.lit(NAME), F.lit("")))


def windows_of(words: str, canon: str, lengths: list[int]) -> Column:
    """(place, hash, whether of the words themselves) of each window; canonical only where it has a slot, else it is the same.

    Windows of other ``lengths`` are of the words themselves.
    """
    both = F.struct(windows(words).alias("e"), windows(canon).alias("c"))
    exact = lambda column: F.transform(column, lambda w, i: F.struct(i.alias("pos"), w.alias("w"), F.lit(True).alias("exact")))
    short = [exact(windows(words, n)) for n in lengths]
    return F.transform(F.array(both), lambda b: F.concat(
        exact(b["e"]),
        F.filter(F.transform(b["c"], lambda w, i: F.struct(i.alias("pos"), w.alias("w"), F.lit(False).alias("exact"))),
                 lambda s: s["w"] != F.get(b["e"], s["pos"])), *short,
    ))[0]


def _pairs(places: str) -> str:
    """Item value and document value at the slots that the windows from these places on cover."""
    return (f"transform(filter(array_distinct(flatten(transform({places}, i -> sequence(i, least(i + {WINDOW}, size(icanon)) - 1)))), j -> {is_slot('icanon[j]')}), "
            "j -> struct(j as j, iwords[j] as a, words[r.shift + j] as b))")


# The windows of one shift in order of the shift, with what they say about the slots.
RUNS = (
    "transform(array_sort(runs), r -> struct(r.shift as shift, r.at_exact as exact, r.at_dense as dense, "
    f"array_intersect(r.at_dense, r.at_exact) as both, {_pairs('r.at')} as pairs, {_pairs('r.at_exact')} as same))")
_NONE = (
    "named_struct('exact', cast(array() as array<int>), 'dense', cast(array() as array<int>), "
    "'pairs', cast(array() as array<struct<j: int, a: string, b: string>>))")
_JOINED = (
    "named_struct('exact', array_union(s.exact, r.exact), 'dense', array_union(s.dense, r.dense), 'pairs', array_union(s.pairs, r.pairs))")
_AGREE = (
    "size(array_distinct(transform(concat(s.pairs, r.pairs), p -> struct(p.a, p.b)))) = "
    "size(array_distinct(transform(concat(s.pairs, r.pairs), p -> p.a)))")
# Shifts are different numbers, so no more runs than this lie within reach on either side; each run looks at these alone.
_NEAR = f"{REACH} * size(icanon)"
_NEAREST = (
    f"array_sort(filter(slice(runs, greatest(n + 1 - {_NEAR}, 1), 2 * {_NEAR} + 1), r -> abs(r.shift - q.shift) <= {_NEAR}), (x, y) -> case "
    "when abs(x.shift - q.shift) < abs(y.shift - q.shift) then -1 when abs(x.shift - q.shift) > abs(y.shift - q.shift) then 1 "
    "when x.shift < y.shift then -1 when x.shift > y.shift then 1 else 0 end)")
# What can be put together: all windows that are word for word, and from each run on the nearest others whose values agree.
TRIES = (
    f"concat(array(aggregate(runs, {_NONE}, (s, r) -> named_struct('exact', array_union(s.exact, r.exact), "
    "'dense', array_union(s.dense, r.both), 'pairs', array_union(s.pairs, r.same)))), "
    f"transform(runs, (q, n) -> aggregate({_NEAREST}, {_NONE}, (s, r) -> if({_AGREE}, {_JOINED}, s))))")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``id``, ``h`` (hash of the text), ``item``, shared windows, ``share``, ``slots``, ``changed`` and ``kind`` of every hit."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("h"), "text")
    items = benchmark.select(F.col(item).alias("item"), F.filter(tokens(F.col(item_text)), lambda w: w != "").alias("marked"))
    items = items.select("item", plain("marked").alias("iwords"), canonical("marked").alias("icanon"))
    # At most five lengths, and none where all items are long.
    size = F.size("iwords")
    lengths = sorted(r["n"] for r in items.select(size.alias("n")).where(size.between(SHORT, WINDOW - 1)).distinct().collect())
    own = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64("iwords").alias("w"), F.lit(True).alias("exact")))
    whole = F.when(size.between(SHORT, WINDOW - 1), own).otherwise(windows_of("iwords", "icanon", []))
    listed = items.select("item", "icanon", F.inline(whole).alias("ipos", "w", "exact"))
    literal = F.expr(f"size(filter(slice(icanon, ipos + 1, {WINDOW}), c -> not ({is_slot('c')})))")
    listed = listed.select("item", "ipos", "w", "exact", (literal >= LITERAL).alias("dense"), (literal > 0).alias("worded"))
    index = stored(listed.where("exact or dense"), "benchmark-windows")
    sizes = index.groupBy("item").agg(
        F.countDistinct("ipos").alias("n"), F.countDistinct(F.when(F.col("dense"), F.col("ipos"))).alias("n_dense"))
    probe = F.broadcast(index) if index.count() <= BROADCAST_WINDOWS else index

    seen = rows.select("id", "h", tokens(F.col("text")).alias("marked"))
    seen = seen.select("id", "h", plain("marked").alias("words"), canonical("marked").alias("canon"))
    placed = seen.select("id", "h", F.inline(windows_of("words", "canon", lengths)).alias("pos", "w", "exact")).drop("exact")
    only = lambda flag: F.collect_set(F.when(F.col(flag), F.col("ipos")))
    shared = placed.join(probe, "w").groupBy("id", "h", "item", (F.col("pos") - F.col("ipos")).alias("shift")).agg(
        F.collect_set("ipos").alias("at"), only("exact").alias("at_exact"), only("dense").alias("at_dense"),
        F.max("worded").alias("worded")).where("worded")
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    runs = shared.groupBy("id", "h", "item").agg(
        F.collect_list(F.struct("shift", "at", "at_exact", "at_dense")).alias("runs"),
        distinct("at_exact").alias("most_exact"), distinct("at_dense").alias("most_dense"))
    hits = stored(runs.join(sizes, "item").where(f"most_exact >= {SHARE} * n or (n_dense > 0 and most_dense >= {SHARE} * n_dense)"), "hits")

    told = rows.join(hits, rows["id"].eqNullSafe(hits["id"]) & (rows["h"] == hits["h"])).select(
        rows["id"], rows["h"], "item", "runs", "n", "n_dense", plain(tokens(F.col("text"))).alias("words"))
    judged = told.join(items, "item").withColumn("runs", F.expr(RUNS)).withColumn("tries", F.expr(TRIES)).select(
        "id", "h", "item", F.explode("tries").alias("t"), "n", "n_dense")
    share = F.greatest(F.size("t.exact") / F.col("n"), F.when(F.col("n_dense") > 0, F.size("t.dense") / F.col("n_dense")))
    by_words = F.size("t.exact") / F.col("n") == share
    judged = judged.select(
        "id", "h", "item", F.struct(
            share.alias("share"), F.expr("-size(filter(t.pairs, p -> p.a <> p.b))").alias("kept"), F.size("t.pairs").alias("slots"),
            F.when(by_words, F.size("t.exact")).otherwise(F.size("t.dense")).alias("shared")).alias("best"))
    best = judged.where(F.col("best.share") >= SHARE).groupBy("id", "h", "item").agg(F.max("best").alias("best"))
    kind = F.when(F.col("best.kept") < 0, "other parameters").otherwise("same words")
    return best.select("id", "h", "item", "best.shared", "best.share", "best.slots", (-F.col("best.kept")).alias("changed"), kind.alias("kind"))

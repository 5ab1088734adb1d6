"""Positional rare-token index for licence texts, on built-in functions only.

The index holds, for the words of every licence template and key phrase, where they stand; function words are left out. One
pass over the texts notes where index words stand in each file, and the notes, which are small, are stored. From them come
the document frequencies over the whole corpus. The rarest words of each template are then looked up in every file, and
each occurrence votes for the place at which the template would have to begin. Key phrases are short: the rarest word of
each is its anchor, and every place of the anchor is verified word by word, so no place of a phrase is lost. A template is
accepted when enough of its rare words agree on one place and one of its key phrases stands in the file.

Defined results: a null text is empty; a file without words has zero counts, null places, empty labels and score 0;
rows are judged one by one, so repeated rows repeat their result; ties in rarity go to the smaller word; further columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

# Phrases whose places count, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Further key phrases and labels of this operator.
MORE_PHRASES = {
    "cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "hereby granted free": "mit",
    "binary forms": "bsd",
    "gnu lesser general public": "lgpl",
    "gnu affero general public": "agpl",
}
# Label, typical wording, and the key phrases of which one must stand in the file.
TEMPLATES = [
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction", ("hereby granted free",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met", ("binary forms",)),
]
# Words of templates that are never looked up.
FUNCTION_WORDS = frozenset("a an and any are as for in is of or that the this to under use with work".split())
RARE_PER_TEMPLATE = 6
ENOUGH = 0.5
CODES = 256


def vocabulary() -> list[str]:
    phrases = {w for p in (*BASE_PHRASES, *MORE_PHRASES) for w in p.split()}
    return sorted(phrases | {w for _, t, _ in TEMPLATES for w in t.split() if w not in FUNCTION_WORDS})


def words_of(text: Column) -> Column:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case.

    Two letters beyond ASCII have ASCII letters in their lower case, so they are replaced first. The case of other letters beyond
    ASCII does not matter here. A text that begins or ends between words has an empty word there.
    """
    safe = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")), F.lit("\u0130"), F.lit("\u00e9"))
    return F.split(F.lower(safe), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def notes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, number of words, and ``hits``: place * CODES + code of every index word, ascending."""
    known = vocabulary()
    words = docs.select(F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    lead = "if(words[0] = '', 1, 0)"
    tail = "if(size(words) > 1 and words[size(words) - 1] = '', 1, 0)"
    listed = ", ".join(f"'{w}'" for w in known)
    coded = f"cast(i - lead as bigint) * {CODES} + array_position(array({listed}), w) - 1"
    return words.selectExpr("key", "words", f"{lead} as lead", f"{tail} as tail").selectExpr(
        "key", "cast(size(words) - lead - tail as bigint) as n_words",
        f"filter(transform(words, (w, i) -> if(w in ({listed}), {coded}, -1L)), h -> h >= 0) as hits",
    )


def rarity(noted: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every index word; what reaches the driver is as small as the index."""
    known = vocabulary()
    codes = F.array_distinct(F.transform("hits", lambda h: h % CODES))
    held = noted.select(F.explode(F.array_append(codes, F.lit(-1).cast("long"))).alias("code"))
    counts = {r["code"]: r["n"] for r in held.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.get(-1, 0)
    return {w: math.log((1 + total) / (1 + counts.get(k, 0))) for k, w in enumerate(known)}


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, places, labels and a score of every file; the texts are read once and never shuffled."""
    noted = stored(notes(docs, key, text), "licence-notes")
    idf = rarity(noted)
    code = {w: k for k, w in enumerate(vocabulary())}
    rare = lambda ws, n: sorted({w for w in ws if w in code}, key=lambda w: (-idf[w], w))[:n]
    phrases = [(p.split(), label, base) for group, base in ((BASE_PHRASES, True), (MORE_PHRASES, False)) for p, label in group.items()]
    picked = [rare(t.split(), RARE_PER_TEMPLATE) for _, t, _ in TEMPLATES]

    def starts(ws: list[str]) -> Column:
        """Places where a phrase stands: at its anchor, the words around must be the other words at the places around."""
        anchor = rare(ws, 1)[0]
        offset = ws.index(anchor)

        def verified(h, k):
            begin = F.floor(h / CODES) - offset
            wanted = F.array(*[(begin + j) * CODES + code[w] for j, w in enumerate(ws)])
            there = F.when(k >= offset, F.slice("hits", k - offset + 1, len(ws)) == wanted).otherwise(False)
            return F.when((h % CODES == code[anchor]) & there, begin).otherwise(-1)

        return F.filter(F.transform("hits", verified), lambda s: s >= 0)

    def votes(k: int) -> Column:
        """Share of a template's rare words that agree on the best beginning."""
        places = [(w, j) for j, w in enumerate(TEMPLATES[k][1].split()) if w in picked[k]]

        def begin_of(word: str, offset: int) -> Column:
            mine = F.filter("hits", lambda h: h % CODES == code[word])
            return F.transform(mine, lambda h: F.floor(h / CODES) - offset)

        begins = F.flatten(F.array(*[begin_of(w, j) for w, j in places]))
        zero = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

        def step(a, s):
            run = F.when(a["last"] == s, a["run"] + 1).otherwise(1)
            return F.struct(s.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

        return F.aggregate(F.array_sort(begins), zero, step, lambda a: a["best"]) / F.lit(len(places))

    nowhere = F.array().cast("array<bigint>")
    some = F.size("hits") > 0
    found = noted.select(
        "key", "n_words",
        *[F.when(some, starts(ws)).otherwise(nowhere).alias(f"p{k}") for k, (ws, _, _) in enumerate(phrases)],
        *[F.when(some, votes(k)).otherwise(F.lit(0.0)).alias(f"t{k}") for k in range(len(TEMPLATES))],
    )
    place = {" ".join(ws): k for k, (ws, _, _) in enumerate(phrases)}
    base = [k for k, p in enumerate(phrases) if p[2]]
    base_starts = F.flatten(F.array(*[F.col(f"p{k}") for k in base]))
    label = lambda cond, name: F.when(cond, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    by_phrase = [label(F.size(f"p{k}") > 0, phrases[k][1]) for k in range(len(phrases))]
    mandatory = [F.array_max(F.array(*[F.size(f"p{place[p]}") for p in must])) > 0 for _, _, must in TEMPLATES]
    by_template = [label((F.col(f"t{k}") >= ENOUGH) & mandatory[k], TEMPLATES[k][0]) for k in range(len(TEMPLATES))]
    joined = lambda parts: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.array(*parts)))), ",")
    best = F.greatest(*[F.when(mandatory[k], F.col(f"t{k}")).otherwise(0.0) for k in range(len(TEMPLATES))])
    any_phrase = F.greatest(*[F.size(f"p{k}") for k in range(len(phrases))]) > 0
    return found.select(
        F.col("key").alias(key),
        "n_words",
        F.size(base_starts).cast("long").alias("n_base"),
        F.array_min(base_starts).cast("long").alias("first_word"),
        F.array_max(base_starts).cast("long").alias("last_word"),
        joined([by_phrase[k] for k in base]).alias("base_labels"),
        joined([*by_phrase, *by_template]).alias("labels"),
        F.when(any_phrase, F.greatest(best, F.lit(0.5))).otherwise(best).cast("double").alias("score"),
    )

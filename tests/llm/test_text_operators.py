"""The training-data operators on small inputs, against brute force, and on rows that are easily forgotten."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, decontam, langid, licenses, neardup, packing, pii, quality, repeats, sharding
from millrace.llm.queries import PII_KEY, word_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, node string, h string, bits string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", None, "x", "y", "z", "w") for i, t, lang in rows], SCHEMA)


def words(rng, n, letters="abcdefgh"):
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)) for _ in range(1)][0]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null id."""
    rng = random.Random(3)
    long = words(rng, 9000)
    rows = [(1, None, None), (2, "", "en"), (3, "   \n", "en"), (4, long, "en"), (4, long, "en"), (None, words(rng, 50), "en"),
            (6, "a", None), (7, "12 34 ##", "de"), (8, long + " more", "de")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ------------------------------------------------------------------ packing

def test_packing_is_whole_and_dense(spark, odd):
    cut = packing.pieces(odd, word_tokenizer())
    got = packing.pack(cut.withColumn("crc", F.crc32("ids"))).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_tokenizer())
    want = collections.Counter()
    for r in odd.collect():
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        for a in range(0, len(ids), 4096):
            want[r["doc_id"], a, zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["crc"], r["doc_tokens"]) for r in got) == want
    ends = collections.defaultdict(list)
    for r in got:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(ends) == list(range(len(ends)))


def test_packing_of_nothing(spark, nothing):
    assert packing.pack(packing.pieces(nothing, word_tokenizer())).count() == 0


def test_patterns_use_up_any_histogram():
    rng = random.Random(1)
    for _ in range(5):
        histogram = {c: rng.randint(1, 400) for c in rng.sample(range(1, 65), 30)}
        found = packing.patterns(histogram, 64)
        used = collections.Counter()
        for classes, n in found:
            assert sum(classes) <= 64 and n > 0
            for c in classes:
                used[c] += n
        assert used == histogram


def test_documents_pack_densely():
    rng = random.Random(1)
    histogram = {c: 1 + rng.randint(50, 400) // (1 + c // 8) for c in range(1, 65)}
    found = packing.patterns(histogram, 64)
    assert sum(n for _, n in found) <= 1.02 * sum(c * n for c, n in histogram.items()) / 64


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    from millrace.llm.tokens import Encoder

    plain, mine = Tokenizer.from_file(word_tokenizer()), Encoder(word_tokenizer())
    for text in ["It's, IT'S 'x' ΣΑΣ, ΑΣ. don't... 'S word,### a<|endoftext|>, ###, x², ²,", "now<|endoftext|>", "A\u0301, e\u0301!", "İ, ", "", "  a  b\n\nc ", "ΑΣ ΣΑΣ", "é ́x", "it's <|endoftext|>now", "a b\tc\r\nd", "1234 3.5%", "日本 語"]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_together():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from millrace.llm.tokens import Encoder

    plain, mine, given = Tokenizer.from_file(word_tokenizer()), Encoder(word_tokenizer()), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    mine.tokenizer = Counted()
    rng = random.Random(5)
    texts = [words(rng, 1000, letters) for letters in ("abcdefgh", "stuvwxéßñ", "ΑΒΓΣας", "日本語")]
    texts += [texts[0].title().replace(" ", ", "), texts[1].replace(" ", "!\n")]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in mine.encode_all(pa.array(texts))]
    assert got == [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(given) < 50
    distinct = {s.lower() if s.isascii() else s for text in texts for w in text.split() for s in [w.strip(",!")]}
    assert set(mine.known) == distinct | {"", ",", "!"}


def test_words_that_the_tokenizer_breaks():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from millrace.llm.tokens import Encoder

    plain, mine = Tokenizer.from_file(word_tokenizer()), Encoder(word_tokenizer())
    # A letter composed of a letter and a mark, one that is lowered to both, marks, spaces that are no blanks.
    texts = ["ab \ufb2aab cd", "İstanbul ab, É\u0331 H\u0331, h\u0331!", "a\u2003b c\xa0d, \u2003", "ab, ab! <ab> ab<|endoftext|>, É, É!", "", None]
    for each in (texts, texts[1:]):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in mine.encode_all(pa.array(["x", *(t or "" for t in each)]).slice(1))]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in each]


# ------------------------------------------------------------------ licences

def test_license_places(spark):
    rows = [(1, "The MIT License. mit-license, MIT\nlicense", None), (2, None, None), (3, "", None), (4, "...", None),
            (5, "Apache Licensé K apache license general public license", None),
            (6, "Licensed under CC BY-NC 4.0.", None), (7, "mit licenses submit license", None)]
    got = {r["doc_id"]: r.asDict() for r in licenses.scan(frame(spark, rows)).collect()}
    pick = lambda i: tuple(got[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert pick(1) == (7, 3, 1, 5, "mit")
    assert pick(2) == pick(3) == pick(4) == (0, 0, None, None, "")
    assert pick(5) == (8, 2, 3, 5, "apache,gpl")
    assert pick(6)[1:] == (0, None, None, "") and got[6]["labels"] == "cc-by-nc"
    assert pick(7)[1:] == (0, None, None, "")
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_license_scan_of_odd_rows(spark, odd, nothing):
    assert licenses.scan(odd).count() == 9
    assert licenses.scan(nothing).count() == 0


# ------------------------------------------------------------------ decontamination

ITEM = "Anna has 3 red apples and buys 4 kg of flour in town so how many things does she carry home today"


def test_reparameterised_questions_are_found(spark):
    filler = words(random.Random(5), 60, "uvwxyz")
    again = ITEM.replace("3", "17").replace("4", "9").replace("kg", "lb")
    rows = [(1, f"{filler} {ITEM} {filler}", None), (2, f"{filler} {again} {filler}", None), (3, filler, None), (4, None, None),
            (None, ITEM, None), (5, ITEM[:40], None), (6, "1 2 3 4 5 6 7 8 9 10 11 12", None), (1, f"{filler} {ITEM} {filler}", None)]
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (4, "1 2 3 4 5 6 7 8 9 10 11")], "item_id long, text string")
    got = decontam.contaminated(frame(spark, rows), items)
    assert table(got, "id", "item", "kind") == sorted([(None, 1, "same words"), (1, 1, "same words"), (2, 1, "other parameters")], key=repr)


def test_inconsistent_slots_are_no_hit(spark):
    item = "take 5 steps north then 5 steps east then 5 steps south and say where you are in the end"
    rows = [(1, item.replace("5", "8"), None), (2, item.replace("5", "8").replace("8", "9", 2).replace("9", "8", 1), None)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert table(decontam.contaminated(frame(spark, rows), items), "id") == [(1,)]


NATALIA = ("Natalia sold clips to 48 of her friends in April and then she sold half as many clips in May. How many clips "
           "did Natalia sell altogether in April and May?")


def test_partial_edited_and_slot_dense_copies_are_found(spark):
    filler = words(random.Random(7), 40, "uvwxyz")
    numbers = "List 3 7 9 12 15 21 33 45 67 89 91 and 99 in order"
    put = lambda word: NATALIA.replace("she sold", f"she {word} sold")
    other = NATALIA.replace("48", "72").replace("April", "June").replace("May", "July")
    third = NATALIA.replace("48", "13").replace("April", "March").replace("May", "August")
    rows = [(1, f"{filler} {NATALIA.split(' altogether')[0]} {filler}", None), (2, f"{filler} {' '.join(NATALIA.split()[:22])} {filler}", None),
            (3, put("exactly"), None), (4, f"So {put('So')} {filler}", None), (5, f"{filler} {numbers} {filler}", None),
            (6, numbers.replace("9", "8"), None), (7, other.replace("she sold", "she only sold"), None), (8, f"{other} {filler} {third}", None),
            (9, NATALIA.replace("in April and May", "in June and May"), None), (10, f"{third} {filler} {put('exactly')}", None)]
    items = spark.createDataFrame([(1, NATALIA), (2, numbers)], "item_id long, text string")
    got = decontam.contaminated(frame(spark, rows), items)
    # Nine differs in one value only: twenty of its windows are the item's, word for word.
    assert table(got, "id", "item", "kind") == sorted(
        [(i, 1, "same words") for i in (1, 2, 3, 4, 9)] + [(5, 2, "same words"), (7, 1, "other parameters"), (8, 1, "other parameters"),
                                                        (10, 1, "other parameters")], key=repr)


def test_one_changed_name_does_not_hide_a_copy(spark):
    item = ("One day Anna walks to the market with six baskets and fills them with plums while the old farmer tells Anna that every basket of "
            "plums costs more than he asked for in the last dry summer")
    copies = item[::-1].replace("annA", "siroB", 1)[::-1]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontam.contaminated(frame(spark, [(1, copies, None), (2, "One day Anna walks " + words(random.Random(2), 30), None)]), items)
    assert table(got, "id", "kind", "changed") == [(1, "same words", 0)]


def test_short_items_are_looked_for_whole(spark):
    filler = words(random.Random(9), 30, "uvwxyz")
    rows = [(1, f"{filler}. What is two plus two? {filler}", None), (2, f"What is two and two plus two {filler}", None), (3, "what is two, plus two", None),
            (4, f"{filler} the sky is {filler}", None), (5, "7 8 9", None)]
    items = spark.createDataFrame([(1, "What is two plus two?"), (2, "the sky"), (3, "7 8 9"), (4, "(The sky is)")], "item_id long, text string")
    assert table(decontam.contaminated(frame(spark, rows), items), "id", "item", "kind") == [(1, 1, "same words"), (3, 1, "same words"), (4, 4, "same words")]


def brute_exact_share(text, item):
    """Share of an item's windows that stand in a text, word for word."""
    found = lambda t: re.findall(r"[a-z]+", t.lower())
    grams = lambda w: {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
    own = found(item)
    return sum(tuple(own[i : i + 8]) in grams(found(text)) for i in range(len(own) - 7)) / (len(own) - 7)


def test_exact_shares_against_brute_force(spark):
    rng = random.Random(11)
    texts = [words(rng, rng.randint(8, 40), "abcdefgh") for _ in range(12)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(texts).split()
            a = rng.randint(0, len(w) - 1)
            w = w[a : a + rng.randint(1, len(w))]
            if rng.random() < 0.4:
                w.insert(rng.randint(0, len(w)), "zzz")
            parts += [" ".join(w), words(rng, 5, "uvwx")]
        rows.append((i, " ".join(parts), None))
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    want = {(i, k) for i, t, _ in rows for k, item in enumerate(texts) if brute_exact_share(t, item) >= decontam.SHARE}
    assert len(want) > 10 and set(table(decontam.contaminated(frame(spark, rows), items), "id", "item")) == want


def test_many_repeats_of_an_item_cost_in_proportion(spark):
    import time

    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")

    def took(n):
        text = " ".join(ITEM.replace("3", str(i + 10)).replace("4", str(i + 7)) for i in range(n))
        began = time.perf_counter()
        assert decontam.contaminated(frame(spark, [(1, text, None)]), items).count() == 1
        return time.perf_counter() - began

    took(10)
    assert took(800) < 3 * took(400) + 2


def test_decontamination_of_nothing(spark, odd, nothing):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontam.contaminated(nothing, items).count() == 0
    assert decontam.contaminated(odd, items.limit(0)).count() == 0


# ------------------------------------------------------------------ quality rules

def brute_quality(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    often = {k for i in range(len(found) - 7) if grams[tuple(found[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(often)


def test_measures_against_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b ", "cc\n", "# ", "é ", "a b\n", "\t", "\x1c"]) for _ in range(rng.randint(0, 120)))
        assert quality.measure(text)[:5] == brute_quality(text)


def test_ledger_policies_and_ablation(spark, odd, nothing):
    rows = quality.ledger(odd)
    assert rows.count() == 9 and quality.ledger(nothing).count() == 0
    assert rows.where(quality.keeps("v1-base")).count() >= rows.where(quality.keeps("v2-strict")).count()
    report = {r["rule"]: (r["failed"], r["failed_alone"]) for r in quality.ablation(rows).collect()}
    bits = [r["failed_bits"] for r in rows.collect()]
    for name, (bit, _) in quality.RULES.items():
        assert report[name] == (sum(b >> bit & 1 for b in bits), sum(b == 1 << bit for b in bits))


# ------------------------------------------------------------------ near duplicates

def jaccard(a, b):
    cut = lambda t: {tuple(w[k : k + 5]) for w in [re.findall(r"\w+", t.lower())] for k in range(max(1, len(w) - 4))}
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("block", [1024, 4])
def test_classes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = words(rng, 120).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                copy[rng.randrange(len(copy))] = "zz" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(900, None, None), (901, "", None), (902, "tiny text", None), (903, "Tiny, text!", None)]
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    links = collections.Counter()
    distinct = {t: i for i, t in reversed(list(enumerate(texts)))}
    for a in range(len(texts)):
        for b in range(a):
            if jaccard(texts[a], texts[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
                if distinct[texts[a]] == a and distinct[texts[b]] == b and texts[a] != texts[b]:
                    links[texts[a]] += 1
                    links[texts[b]] += 1
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in neardup.classes(frame(spark, rows)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (find(i), links[t])
    assert (got[900], got[901]) == ((900, 0), (901, 0))
    assert got[902][0] == got[903][0] == 902


def test_classes_of_odd_rows(spark, odd, nothing):
    got = table(neardup.classes(odd), "id", "class_id")
    assert len(got) == 9 and got.count((4, 4)) == 2 and (8, 4) in got and (None, None) in got
    assert neardup.classes(nothing).count() == 0


def test_bands_reach_the_recall():
    bands, rows = neardup.bands_for(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999


# ------------------------------------------------------------------ repeated strings

def brute_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            part = data[p : p + 100]
            if part in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("bucket, anchor", [(repeats.BUCKET_BYTES, repeats.ANCHOR_BYTES), (300, repeats.ANCHOR_BYTES), (300, 1500), (300, 150)])
def test_repeats_against_brute_force(spark, monkeypatch, bucket, anchor):
    """All anchors whole; small buckets; most anchors thinned; most of them grouped by bytes after that."""
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    monkeypatch.setattr(repeats.spans, "__defaults__", (bucket, anchor))
    rng = random.Random(4)
    shared = [words(rng, 60, "abcdeé") for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [rng.choice(shared)[rng.randint(0, 50) :] if rng.random() < 0.6 else words(rng, 30) for _ in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(parts)))
    rows += [(50, "ab" * 400), (51, "x" * 99), (52, ""), (53, "é" * 120), (54, rows[0][1])]
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.clean(frame(spark, [(i, t, None) for i, t in rows])).collect()}
    assert got == brute_repeats(rows)


def test_equal_strings_of_many_contexts_do_not_meet_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(repeats.spans, "__defaults__", (2000, 2000))
    whole = repeats.repeats_of_bucket

    def small(bucket):
        size = sum(len(b) + 1 for b in bucket["bytes"].to_pylist())
        assert size <= 20_000, size
        return whole(bucket)

    monkeypatch.setattr(repeats, "repeats_of_bucket", small)
    rng = random.Random(14)
    passage = words(rng, 60)
    rows = [(i, f"{words(rng, 30)} {passage} {words(rng, 30)}") for i in range(300)]
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.clean(frame(spark, [(i, t, None) for i, t in rows])).collect()}
    assert got == brute_repeats(rows)


def test_repeats_of_odd_rows(spark, odd, nothing):
    got = table(repeats.clean(odd), "doc_id", "n_removed")
    assert got.count((4, 0)) == 2 and (1, 0) in got and len(got) == 9
    assert repeats.clean(nothing).count() == 0


# ------------------------------------------------------------------ language

def test_languages_held_out(spark):
    rng = random.Random(2)
    make = {"aa": lambda: words(rng, 40, "abcdefgh"), "bb": lambda: words(rng, 40, "ghijklmn"), "cc": lambda: words(rng, 40, "mnopqrst")}
    rows = [(k, make[lang](), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 40)] + [(900, None, "aa"), (901, "12 !", "aa"), (902, "", None)]
    got = langid.identify(frame(spark, rows)).select("doc_id", "lang", "language.*").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] < 900)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] >= 900)
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("columns", [langid.COLUMNS, 2])
def test_phrases_against_plain_parsing(monkeypatch, columns):
    monkeypatch.setattr(langid, "COLUMNS", columns)
    rng = random.Random(6)
    model = langid.Model([("a", words(rng, 80, "abc")), ("b", words(rng, 80, "bcd"))])
    texts = [words(rng, 30, "abcd") for _ in range(5)] + ["", "dd", "ab?!c é"]
    phrases, _, _ = model.parsed(texts)
    go = lambda sample, state, code: int(sample.follow(np.array([state]), np.array([code]))[0])
    for t, counted in zip(texts, phrases):
        codes, _ = model.codes([t])
        for k, sample in enumerate(model.tables):
            n, at = 0, 0
            while at < len(codes):
                state, end = 0, at
                while end < len(codes) and go(sample, state, codes[end]) >= 0:
                    state, end = go(sample, state, codes[end]), end + 1
                n, at = n + 1, max(end, at + 1)
            assert counted[k] == n


def test_scripts_of_very_many_letters(spark):
    rng = random.Random(16)
    of = {"zh": [chr(c) for c in range(0x4E00, 0x4E00 + 3500)], "ko": [chr(c) for c in range(0xAC00, 0xAC00 + 3500)], "en": list("abcdefghilmnorstu")}
    lexicon = {k: ["".join(rng.choices(v, k=rng.randint(2, 4))) for _ in range(900)] for k, v in of.items()}
    text = lambda k: " ".join(rng.choices(lexicon[k], k=60))
    rows = [(i, text(k), k) for i, k in enumerate(["zh", "ko", "en"] * 80)]
    got = langid.identify(frame(spark, rows)).select("doc_id", "lang", "language.*").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)
    greek = frame(spark, [*rows, (999, "ένα μικρό σκυλί τρέχει γρήγορα στον δρόμο", None), (998, "a", "en"), (997, "12", "en")])
    told = langid.identify(greek).where(langid.doubtful("language"))
    assert table(told, "doc_id") == [(997,), (999,)]


def test_language_without_labels(spark, nothing):
    got = langid.identify(frame(spark, [(1, "some text", None)])).select("language.lang_pred").first()
    assert got[0] == "und" and langid.identify(nothing).count() == 0


# ------------------------------------------------------------------ sharding

def test_shards_are_even_and_repeatable(spark, odd, nothing):
    rows = frame(spark, [(i, f"text {i % 7}", None) for i in range(500)])
    place = lambda df: table(sharding.shuffle_into_shards(df, 7), "doc.doc_id", "shard", "slot")
    got = place(rows)
    assert got == place(rows.repartition(5)) and len(got) == 500
    slots = collections.defaultdict(list)
    for _, shard, slot in got:
        slots[shard].append(slot)
    assert {len(s) for s in slots.values()} <= {71, 72} and all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [i for i, _, _ in sorted(got, key=lambda r: r[1:])]
    assert abs(np.corrcoef(order, range(500))[0, 1]) < 0.2
    assert sharding.shuffle_into_shards(odd).select("doc.*").count() == 9
    assert sharding.shuffle_into_shards(nothing).count() == 0


def test_copies_do_not_fill_one_bucket(spark, monkeypatch):
    plain = sharding.fisher_yates

    def small(seed):
        run = plain(seed)

        def checked(key, bucket):
            assert bucket.num_rows <= 120, bucket.num_rows
            return run(key, bucket)

        return checked

    monkeypatch.setattr(sharding, "fisher_yates", small)
    rows = frame(spark, [(1, f"text {i} of one id", None) for i in range(600)] + [(2, "the same text again and again", None)] * 600
                 + [(None, f"text {i} without id", None) for i in range(300)] + [(None, None, None)] * 300)
    place = lambda df: table(sharding.shuffle_into_shards(df, 7, bucket_bytes=2000), "doc.doc_id", "doc.text", "shard", "slot")
    got = place(rows)
    assert got == place(rows.repartition(5)) and len({r[2:] for r in got}) == len(got) == 1800


# ------------------------------------------------------------------ personal data

def test_pseudonyms_keep_format_and_can_be_undone():
    there, back = pii.Pseudonyms(b"key"), pii.Pseudonyms(b"key", back=True)
    text = ("card 4539 1488 0343 6467 or 4539148803436467, not 4539148803436468; +1 (476) 555-6291; 123-45-6789; 000-12-3456; "
            "10.0.0.7 and 300.1.1.1; 2021-02-28, 31.12.1999, 05/17/2020, 2021-02-30; jo.doe9@mail.example.com; GB82 WEST 1234 5698 7654 32; " + "ab12" * 10)
    new, found = there.text(text)
    assert found == {"card": 2, "phone": 1, "ssn": 1, "ipv4": 1, "date": 3, "email": 1, "iban": 1, "secret": 1}
    for left in ("4539148803436468", "000-12-3456", "300.1.1.1", "2021-02-30"):
        assert left in new
    a, b = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", new)[:2]
    assert a.replace(" ", "") == b and pii.luhn_digit(b[:-1]) == b[-1]
    assert back.text(new)[0] == text


def test_pseudonyms_of_other_scripts_and_national_forms():
    there, back = pii.Pseudonyms(b"key"), pii.Pseudonyms(b"key", back=True)
    names = ["иванов", "Иванов.7", "παπάς", "محمد", "山田太郎", "김철수", "İvan.b", "jürgen", "jose\u0301", "राम"]
    phones = ["(017) 555-7713", "555-123-4567", "(030) 12345678", "030 1234567", "1-555-123-4567", "555.123.4567", "(476) 555-6291"]
    others = ["3782 822463 10005", "2021-03-04T10:00", "2021-03-04T10:00:00Z"]
    for value, kind in [*[(f"{n}@mail.example.com", "email") for n in names], *[(p, "phone") for p in phones],
                        (others[0], "card"), *[(d, "date") for d in others[1:]]]:
        text = f"so {value} it is"
        new, found = there.text(text)
        assert found == {kind: 1} and new != text and len(new) == len(text), (value, new, found)
        assert back.text(new)[0] == text, value
    for left in ("_+_@mail.example.com", "3782 822463 10006", "2021-02-30T10:00", "2021-03-04Tea"):
        assert there.text(left) == (left, {})


def test_pseudonyms_in_rows(spark, odd, nothing):
    rows = frame(spark, [(1, None, None), (2, "", None), (3, "no data here", None), (4, "write to x.y@z.example.org", None), (4, "write to x.y@z.example.org", None)])
    got = pii.pseudonymise(rows, PII_KEY)
    assert got.columns == [*rows.columns, "pii_found"]
    texts = [r["text"] for r in got.orderBy("doc_id").collect()]
    assert texts[:3] == [None, "", "no data here"] and texts[3] == texts[4] != "write to x.y@z.example.org"
    assert pii.pseudonymise(odd, PII_KEY).count() == 9 and pii.pseudonymise(nothing, PII_KEY).count() == 0


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"key")
    assert sorted(f.permute(v, 1000, "t") for v in range(1000)) == list(range(1000))
    assert all(f.permute(f.permute(v, 1000, "t"), 1000, "t", True) == v for v in range(1000))


# ------------------------------------------------------------------ transcripts

def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("block", [512, 2])
def test_transcripts_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rng = random.Random(8)
    rows = []
    for conv in range(20):
        for turn in range(rng.randint(1, 9)):
            role = "system" if turn == 0 and conv % 4 == 0 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, "\n".join(words(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 4)))))
    turns = chat.transcript(talk(spark, rows), "conv_id", "turn", "role", "text")
    got = chat.parse(turns, chat.fit(turns))
    assert table(got, "conv", "turn", "role", "text") == sorted(rows, key=repr)


def test_lost_markers_are_recovered(spark):
    rng = random.Random(12)
    rows = [(c, t, ("user", "assistant")[t % 2], words(rng, 5) + "?" if t % 2 == 0 else words(rng, 60)) for c in range(60) for t in range(6)]
    turns = chat.transcript(talk(spark, rows), "conv_id", "turn", "role", "text")
    model = chat.fit(turns)
    lines = [("User: " if t % 2 == 0 else "Assistant: ") * (rng.random() < 0.7) + text for _, t, _, text in rows[:120]]
    codes = chat.symbols(lines)
    one = np.array([len(codes)])
    alone, _ = chat.transfer(codes, one, model)
    path = chat.decode(codes, one, model, np.array([-1]), alone.argmax(axis=1))
    right = sum(chat.STATES[s][0] == rows[k][2] for k, s in enumerate(path))
    assert right >= 0.9 * len(path)


def test_side_by_side_decoding_is_plain_viterbi():
    rng = np.random.default_rng(5)
    model = chat.Model(rng.random(6), rng.random((6, 6)), rng.random((6, 20)))
    lengths = np.array([3, 1, 7, 3, 2])
    codes = rng.integers(0, 20, lengths.sum())
    alone, through = chat.transfer(codes, lengths, model)
    path = chat.decode(codes, lengths, model, np.full(5, -1), alone.argmax(axis=1))
    for k, (a, n) in enumerate(zip(np.cumsum(lengths) - lengths, lengths)):
        part = codes[a : a + n]
        score = lambda states: model.start[states[0]] + sum(model.move[p, q] for p, q in zip(states, states[1:])) + sum(model.emit[s, c] for s, c in zip(states, part))  # noqa: E731,B023
        if n <= 3:
            want = max(itertools.product(range(6), repeat=int(n)), key=score)
            assert tuple(path[a : a + n]) == want
        assert score(path[a : a + n]) == pytest.approx(alone[k].max())
    first = model.emit[:, codes[0]] + model.move
    assert through[0].max(axis=1) == pytest.approx(
        ((first[:, :, None] + model.move + model.emit[:, codes[1]]).max(axis=1)[:, :, None] + model.move + model.emit[:, codes[2]]).max(axis=1).max(axis=1))


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "more"), (None, 0, "user", "hello"), (2, None, "user", "a"), (2, None, "user", "a"), (3, 0, "robot", "b")]
    turns = chat.transcript(talk(spark, rows), "conv_id", "turn", "role", "text")
    got = chat.parse(turns, chat.fit(turns)).collect()
    assert {r["conv"] for r in got} == {1, 2, 3, None}
    empty = chat.transcript(talk(spark, []), "conv_id", "turn", "role", "text")
    assert chat.parse(empty, chat.fit(empty)).count() == 0

"""Quality classifier, filter audit and hard negatives: brute force, held-out accuracy, and rows that are easily forgotten."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hardneg, interactions, quality_fm

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bits string, digest string, t string, c string"
LABELS = "doc_id long, quality int, toxic int, part string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", n, "x", "y", "z", "w") for i, t, lang, n in rows], DOCS)


# --------------------------------------------------------------- filter audit

def failures(text, key, first):
    words = text.split(" ") if False else [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        "D": any(c in "#$%&*|" for c in text), "E": key is not None and first is not None and key > first}


def brute_audit(rows, labels):
    firsts = {}
    for i, t, _ in rows:
        t = t or ""
        if i is not None:
            firsts[t] = min(firsts.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, t, lang in rows:
        parts[lang or ""].append((i, failures(t or "", i, firsts.get(t or ""))))
    out = {}
    for part, own in parts.items():
        removed_by = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                now = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                removed_by[f] += len(now)
                out[part, "".join(order), step] = [
                    len(left), len(now), sum(d[1][f] for d in gone), alone, sum(d[0] in good for d in now), sum(d[0] in toxic for d in now)]
                gone = gone + now
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(removed_by[f])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    got = interactions.audit(docs(spark, [(*r, 5) for r in rows]), spark.createDataFrame([(*r, "q") for r in labels], LABELS)).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in got}
    assert len(found) == len(got)
    return found


def test_audit_against_brute_force(spark):
    rng = random.Random(1)
    pool = [" ".join(rng.choices(["aa", "bb", "Cc", "dé", "#x", "ee", "ff", "gg"], k=rng.choice([1, 30, 250]))) for _ in range(12)]
    pool += [" ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(210)), "\x0b".join(f"ö{i}" for i in range(201))]
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None])) for i in range(120)]
    rows += [(3, None, "en"), (4, "", "en"), (4, "", "en"), (None, pool[0], "en"), (None, None, "fr"), (7, "x" * 100_000, "de"), (9, "y", "")]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 120, 2)] + [(4, 0, 0), (4, 1, None), (None, 1, 1), (999, 1, 1)]
    assert audited(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_of_nothing(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    assert len(audited(spark, [(1, "a", "en")], [])) == 600


def test_gray_walk_toggles_one_filter_at_a_time():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, (interactions.STATES, 2))
    got = interactions.walk(counts)
    for s in range(interactions.STATES):
        assert got[s].tolist() == sum((counts[m] for m in range(interactions.STATES) if not m & s), np.zeros(2, int)).tolist()


# --------------------------------------------------------------- hard negatives

ROWS = "vec_id long, embedding array<float>, label int, q string, block string, tile string, a string"


def brute_negatives(rows, every=50):
    usable = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = 2**63
    rank = lambda s, i: (-s, last if i is None else i)
    out = []
    for n, (i, v, label) in enumerate(usable):
        if i is None or i % every:
            continue
        others = [(score(v, w), j, k) for m, (j, w, k) in enumerate(usable) if m != n]
        same = sorted(((s, j) for s, j, k in others if k == label), key=lambda x: rank(*x))[:5]
        for p, j in same:
            fits = sorted(((s, o) for s, o, k in others if k != label and 50 * p <= 100 * s <= 95 * p), key=lambda x: rank(*x))[:3]
            out += [(i, j, r, o, p, s) for r, (s, o) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, k, "x", "y", "z", "w") for i, v, k in rows], ROWS)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[n] for n in names) for r in hardneg.mine(frame, **options).collect()), key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK", 16), ("TILE", 3), ("PAGE", 4), ("PROBE", 1), ("SORTED", 64)):
        monkeypatch.setattr(hardneg, name, value)


def test_negatives_against_brute_force(spark, small_blocks):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(400):
        c = rng.choice(centres)
        rows.append((i * 5, [x + rng.gauss(0, 0.3) for x in c], rng.randint(0, 3)))
    same = [0.5, 0.25, 0.125, 0.0, -0.5, 1.0]
    rows += [(10_000 + i, same, i % 3) for i in range(80)]  # one vector in many rows: ties over several blocks
    rows += [(2, None, 1), (4, [1.0, None], 1), (50, [float("nan"), 1.0], 1), (100, [float("inf")], 0), (150, [1.0] * 6, None), (None, same, 1),
             (None, same, 2), (3000, [], 1), (3050, [1.0], 2), (3100, [0.1] * 8, 2), (10_000, same, 0)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_large_components(spark, small_blocks):
    rng = random.Random(6)
    rows = [(i * 10, [rng.uniform(-3e4, 3e4) for _ in range(3)], i % 2) for i in range(60)]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, [(0, [3e38, -3e38], 1), (50, [3e38, 3e38], 1), (1, [1.0, 2.0], 2)]) == []


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    assert mined(spark, [(51, [1.0], 1), (52, [1.0], 2)]) == []


def test_blocks_out_of_reach_are_not_read(spark, small_blocks):
    rng = random.Random(7)
    rows = []
    for i in range(320):
        centre = [40.0 if d == i % 8 else 0.0 for d in range(8)]
        rows.append((i, [x + rng.gauss(0, 0.2) for x in centre], i // 8 % 2))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    index = hardneg.Index(frame, key="vec_id", vector="embedding", label="label", every=50, scale=256)
    windows = hardneg.open_windows(index.tiles)
    probes = index.wanted(windows, True, True)
    found = hardneg.first(index.read(probes, windows, True, 5), 5)
    raised = hardneg.raise_windows(windows, found, 5)
    every = index.tiles.count() * index.blocks.count()
    assert index.wanted(raised, True, False).count() < every / 2
    assert index.wanted(windows, True, False).count() == every


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = hardneg.hilbert(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        walked = grid[np.argsort(place)]
        assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(3)
    a, block = rng.integers(-300, 300, (20, 7)), rng.integers(-300, 300, (30, 7))
    low, high = hardneg.bounds(a, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = a @ block.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (high[:, 0] >= scores.max(axis=1)).all()


# --------------------------------------------------------------- quality classifier

def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdeghilmnoprstu", k=rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        text = sentence(rng, rng.randint(20, 80))
        if not good:
            text = rng.choice([text.upper(), text.replace(" ", " | "), "buy now " * 40, text.replace(" ", "$$$ ")])
        rows.append((i, text, "en", len(text)))
        labels.append((i, int(good), 0, "p"))
    return rows, labels


def test_scores_equal_all_pairs():
    """The sum-of-squares form is the sum over all pairs of features."""
    rng = np.random.default_rng(4)
    machine = quality_fm.Machine(0.3)
    machine.w[:] = rng.normal(0, 0.1, quality_fm.BINS)
    ids, x = quality_fm.features(b"one two three two THREE #4", None)
    z = machine.b[0] + sum(machine.w[i] * v for i, v in zip(ids, x))
    for p, q in itertools.combinations(range(len(ids)), 2):
        z += float(machine.v[ids[p]] @ machine.v[ids[q]]) * x[p] * x[q]
    got = machine.scores(np.concatenate([ids, ids]), np.concatenate([x, x]), np.array([0, len(ids)]))
    assert np.allclose(got, 1 / (1 + np.exp(-z)))


def test_slopes_are_those_of_the_loss():
    rows = [quality_fm.features(t, 3) for t in (b"a b c", b"d e f f", b"a f")]
    machine = quality_fm.Machine(0.0)
    before = machine.scores(*[np.concatenate([r[k] for r in rows]) for k in (0, 1)], np.cumsum([0, *[len(r[0]) for r in rows]])[:-1])
    machine.fit(rows, np.array([1.0, 0.0, 1.0]), np.ones(3))
    after = machine.scores(*[np.concatenate([r[k] for r in rows]) for k in (0, 1)], np.cumsum([0, *[len(r[0]) for r in rows]])[:-1])
    assert after[0] > before[0] and after[1] < before[1] and after[2] > before[2]


def test_held_out_accuracy(spark):
    rng = random.Random(8)
    rows, labels = corpus(rng, 900)
    told = quality_fm.classify(docs(spark, rows), spark.createDataFrame(labels, LABELS), result="score")
    got = {r["doc_id"]: (r["held"], r["score"]) for r in told.select("doc_id", "score", quality_fm.held_out().alias("held")).collect()}
    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, (held, _) in got.items())
    judged = [((s >= quality_fm.THRESHOLD) == bool(labels[i][1])) for i, (held, s) in got.items() if held]
    assert len(judged) > 100 and np.mean(judged) > 0.95


def test_scores_do_not_depend_on_labels_of_held_out_rows(spark):
    rng = random.Random(9)
    rows, labels = corpus(rng, 150)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, x, p) for i, q, x, p in labels]
    score = lambda known: {r[0]: r[1] for r in quality_fm.classify(
        docs(spark, rows), spark.createDataFrame(known, LABELS), result="score").select("doc_id", "score").collect()}
    assert score(labels) == score(flipped)


def test_classifier_of_odd_rows(spark):
    rng = random.Random(10)
    rows, labels = corpus(rng, 60)
    rows += [(100, None, None, None), (101, "", "en", 0), (102, "w " * 200_000, "en", -5), (None, "a b", "en", 3), (3, "again", "en", 5), (3, "again", "en", 5)]
    labels += [(3, 0, 0, "p"), (None, 0, 0, "p"), (4, None, 0, "p"), (5, 7, 0, "p")]
    told = quality_fm.classify(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    got = told.collect()
    assert len(got) == len(rows) and told.columns[-1] == "quality_score"
    assert all(0 <= r["quality_score"] <= 1 for r in got)
    assert len({r["quality_score"] for r in got if r["doc_id"] == 3 and r["text"] == "again"}) == 1
    none = spark.createDataFrame([], LABELS)
    assert {r["quality_score"] for r in quality_fm.classify(docs(spark, rows), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0, "p") for i in range(9)], LABELS)
    assert {round(r["quality_score"], 6) for r in quality_fm.classify(docs(spark, rows), one).collect()} == {1.0}
    assert quality_fm.classify(docs(spark, []), none).count() == 0

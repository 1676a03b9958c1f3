"""Learning of pronunciations against plain Python, one number at a time."""

import re
import math
import random

import pytest

from corpusflow.operators import lexicons as L

ALPHA, BETA, DELTA = {"R": 0.02, "G": 0.06, "P": 0.1}, {"R": 0.0, "G": 5.0, "P": 10.0}, 1e-6


def plain_choice(words, variants, mass, reference_mass):
    """{word: pronunciations} of {word: [(pron, source, posterior)]}."""
    out = {}
    for word, rows in words.items():
        rows = sorted(rows, key=lambda r: (-r[2], "PGR".index(r[1]), r[0]))
        known = {p for p, s, _ in rows if s == "R"}
        most, taken, total, chosen, last = math.ceil(1.5 * len(known)) if known else variants, 0, 0.0, set(), None
        while rows and ((taken < most and total < mass) or rows[0][2] == last):
            pron, _, last = rows.pop(0)
            chosen, taken, total = chosen | {pron}, taken + 1, total + last
        for pron, _, share in rows:
            if taken < most and total < reference_mass and pron in known:
                chosen, taken, total = chosen | {pron}, taken + 1, total + share
        out[word] = chosen
    return out


def test_posteriors_and_choice(spark):
    rng = random.Random(1)
    lexicons = [[(f"w{rng.randint(0, 25)}", f"p{rng.randint(0, 9)}") for _ in range(n)] for n in (40, 60, 90)]
    counts = {(f"w{k}", f"p{i}"): float(rng.choice([0, 1, 1, 2, 7, 30])) for k in range(26) for i in range(10) if rng.random() < 0.7}
    seen = [(f"w{k}",) for k in range(24)]
    frame = lambda rows: spark.createDataFrame(rows, "word string, pron string")
    c = L.candidates(*map(frame, [*lexicons[:2], [*lexicons[2], ("w1", "a SIL"), ("w1", "SILK a")]]), spark.createDataFrame(seen, "word string"), ["SIL"])
    n = spark.createDataFrame([(*k, v) for k, v in counts.items()], "word string, pron string, n double")
    mean = {"R": 0.6, "G": 0.3, "P": 0.1}
    post = L.pron_posteriors(c, n, mean, 15.0)
    held: dict = {}
    for s, rows in zip("RGP", [*lexicons[:2], [*lexicons[2], ("w1", "SILK a")]], strict=True):
        for w, p in set(rows):
            if (w,) in seen:
                held.setdefault(w, {}).setdefault(s, set()).add(p)
    want = {}
    for w, by in held.items():
        total = sum(mean[s] for s in by)
        soft = {(p, s): 15.0 * mean[s] / total / len(by[s]) + counts.get((w, p), 0) for s in by for p in by[s]}
        want |= {(w, p, s): v / sum(soft.values()) for (p, s), v in soft.items()}
    rows = post.collect()
    got = {(r.word, r.pron, r.source): r.posterior for r in rows}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    rounded: dict = {}
    for r in rows:
        rounded.setdefault(r.word, []).append((r.pron, r.source, round(r.posterior, 6)))
    exact = spark.createDataFrame([(w, *x) for w, xs in rounded.items() for x in xs], "word string, pron string, source string, posterior double")
    for settings in ((1, 0.7, 0.9), (3, 0.5, 0.99), (2, 0.95, 0.96)):
        chosen: dict = {}
        for r in L.select_by_posterior(exact, *settings).collect():
            chosen.setdefault(r.word, set()).add(r.pron)
        assert chosen == plain_choice(rounded, *settings)


def plain_em(rows, share, close):
    last = None
    while True:
        total = sum(share)
        share, now = [x / total for x in share], 0.0
        new = [0.0] * len(share)
        for row in rows:
            joint = [a * b for a, b in zip(row, share, strict=True)]
            new = [x + y / sum(joint) for x, y in zip(new, joint, strict=True)]
            now += math.log(sum(joint))
        share, now = [x / len(rows) for x in new], now / len(rows)
        if last is not None and abs(now - last) <= close:
            return share, now
        last = now


def plain_greedy(rows, sources):
    rows, share, active = [[max(x, DELTA) for x in r] for r in rows], [1 / len(sources)] * len(sources), list(range(len(sources)))

    def less(i):
        changed = [0.0 if j == i else x + 0.01 * (j in active) for j, x in enumerate(share)]
        return [x / sum(changed) for x in changed]

    while len(active) > 1:
        share, full = plain_em(rows, share, 1e-7)
        scores = [((full - plain_em(rows, less(i), 1e-3)[1]) * len(rows) / (len(rows) + BETA[sources[i]]) + ALPHA[sources[i]] * math.log(DELTA), i) for i in active]
        if min(scores)[0] >= 0:
            break
        gone = min(scores)[1]
        active.remove(gone)
        share = less(gone)
    return active


def test_greedy_choice(spark):
    rng = random.Random(2)
    lexicon, arcs, want = [], [], {}
    for k in range(25):
        word, prons = f"w{k}", sorted(rng.sample("abcdefgh", rng.randint(1, 5)))
        sources = [rng.choice("RGP") for _ in prons]
        lexicon += [(word, p, s) for p, s in zip(prons, sources, strict=True)]
        likely, rows = rng.sample(range(len(prons)), rng.randint(1, len(prons))), []
        for u in range(rng.randint(1, 60)):
            best = rng.choice(likely)
            row = [round(rng.choice([0, 0.1, 0.2]) if i != best else rng.choice([0.6, 0.9, 1.0]), 2) for i in range(len(prons))]
            rows.append(row)
            arcs += [(word, u, 10 * u, p, x) for p, x in zip(prons, row, strict=True) if x] + [(word, u, 10 * u, "unheard", 0.5)]
        want[word] = {prons[i] for i in plain_greedy(rows, sources)}
    c = spark.createDataFrame([*lexicon, ("silent", "a", "R")], "word string, pron string, source string")
    a = spark.createDataFrame(arcs, "word string, utt int, start int, pron string, n double")
    got: dict = {}
    for r in L.select_greedily(c, a, ALPHA, BETA, DELTA).collect():
        got.setdefault(r.word, set()).add(r.pron)
    assert got == want and sum(len(x) for x in want.values()) < len(lexicon)


def test_unsettled_and_crowded_words_are_errors(spark, monkeypatch):
    c = spark.createDataFrame([("w", "a", "R"), ("w", "b", "G")], "word string, pron string, source string")
    a = spark.createDataFrame([("w", 1, 0, "a", 0.5), ("w", 2, 0, "b", 0.25), ("w", 3, 0, "b", 0.5)], "word string, utt int, start int, pron string, n double")
    monkeypatch.setattr(L, "MOST_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="not settled"):
        L.greedy_choice(__import__("numpy").array([[0.5, 0.1]]), __import__("numpy").array([1]), "RG", ALPHA, BETA, DELTA)
    assert {r.pron for r in L.edited_lexicon(c, L.lexicon_edits(c, c.filter("pron = 'b'"), a.groupBy("word", "pron").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n"))).collect()} == {"b"}


def test_places_are_counted_before_they_meet_their_word(spark):
    """A word's places would else be joined in one task (F15)."""
    c = spark.createDataFrame([("a", "x", "R"), ("a", "y", "G")], "word string, pron string, source string")
    arcs = spark.createDataFrame([("a", u, 0, p, 0.5) for u in range(9) for p in "xz"], "word string, utt int, start int, pron string, n double")
    chosen = L.select_greedily(c, arcs, ALPHA, BETA, DELTA)
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner[\s\S]*Aggregate \[word#\d+, heard#\d+\]", plan)
    assert [(r.word, r.pron) for r in chosen.collect()] == [("a", "x")]

"""Timed edits: the stages of segment construction against plain Python, and merging against a walk with two pointers."""

import random

import pytest

from corpusflow.functions import kernels
from corpusflow.operators import segments as G

EPS = G.EPS
RULES = G.SegmentRules(unscored=("noise", "cough"))


def tainted(x):
    return x["tainted"]


class Piece:
    """A segment of the plain version: lines a to b, both in it."""

    def __init__(self, lines, a, b, keep=(1.0, 1.0)):
        self.lines, self.a, self.b, self.keep, self.pad, self.dropped = lines, a, b, list(keep), [0.0, 0.0], []

    def edge(self, side):
        return self.lines[self.b if side else self.a]

    def begin(self):
        x = self.edge(0)
        return x["start"] + x["dur"] * (1 - self.keep[0]) - self.pad[0]

    def end(self):
        x = self.edge(1)
        return x["start"] + x["dur"] * self.keep[1] + self.pad[1]

    def length(self):
        return self.end() - self.begin()

    def junk(self, side):
        return self.pad[side] + (self.edge(side)["dur"] * self.keep[side] if tainted(self.edge(side)) else 0)


def plain_segments(lines, r):
    """(start, end, text) of the segments of one utterance."""
    scored = lambda x: x["ref"] not in r.unscored
    seed = [x["edit_type"] == "cor" and x["hyp"] == x["ref"] for x in lines]
    able = [s or (not tainted(x) and x["edit_type"] in ("cor", "sil", "fix")) for s, x in zip(seed, lines, strict=True)]
    total, pieces, i = lines[-1]["start"] + lines[-1]["dur"], [], 0
    while i < len(lines):
        j = i
        while j < len(lines) and able[j]:
            j += 1
        if j > i and any(seed[i:j]):
            a = i - 1 if i and tainted(lines[i - 1]) and lines[i]["edit_type"] == "cor" else i
            b = j if j < len(lines) and tainted(lines[j]) and lines[j - 1]["edit_type"] == "cor" else j - 1
            stops = [k for k in range(a + 1, b) if (lines[k]["edit_type"] == "sil" and lines[k]["dur"] > r.inner_silence) or (not scored(lines[k]) and lines[k]["dur"] > r.inner_unscored)]
            cuts = [a, *stops, b]
            pieces += [Piece(lines, x, y, (0.5 if n else 1.0, 0.5 if n < len(stops) else 1.0)) for n, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))]
        i = max(j, i + 1)
    for p in pieces:
        for side in (0, 1):
            x = p.edge(side)
            if x["edit_type"] == "sil" and x["dur"] > r.edge_silence:
                p.keep[side] = r.edge_silence / x["dur"]
            elif not scored(x) and x["dur"] > r.edge_unscored:
                p.keep[side] = r.edge_unscored / x["dur"]
        goal, now, before = max(r.least, r.least_new), p.length(), list(p.keep)
        if p.keep != [1.0, 1.0] and now < goal:
            p.keep = [k if tainted(p.edge(s)) else 1.0 for s, k in enumerate(before)]
            loose = p.length()
            if loose > goal:
                a = (goal - loose) / (now - loose)
                p.keep = [a * x + (1 - a) * y for x, y in zip(before, p.keep, strict=True)]
        for side in (0, 1):
            x = p.edge(side)
            if x["edit_type"] == "cor" and scored(x):
                room = min(r.padding, total - x["start"] - x["dur"] if side else x["start"])
                p.pad[side] = room if room >= r.padding / 2 else 0.0
    pieces = [p for p in pieces if (p.length() >= 0.999 * r.least_new or (abs(p.begin()) < 0.001 and abs(p.end() - total) < 0.001)) and p.length() >= 0.999 * r.least]
    for p in pieces:
        for side in (0, 1):
            inner = [k for k in range(p.a + 1, p.b) if lines[k]["dur"] > r.cut_from and (lines[k]["edit_type"] == "sil" or (lines[k]["edit_type"] == "cor" and not scored(lines[k])))]
            if p.junk(side) and inner:
                k = inner[-1] if side else inner[0]
                gone = p.end() - lines[k]["start"] - lines[k]["dur"] if side else lines[k]["start"] - p.begin()
                if p.junk(side) / gone >= r.junk:
                    p.a, p.b = (p.a, k) if side else (k, p.b)
                    p.pad[side], p.keep[side] = 0.0, 1.0
    good = lambda p: any(seed[k] and scored(lines[k]) for k in range(p.a, p.b + 1))
    pieces = [p for p in pieces if good(p) and (p.junk(0) + p.junk(1)) / p.length() <= r.junk]
    whole = []
    for p in pieces:
        if whole and whole[-1].end() >= p.begin():
            q = whole[-1]
            between = range(min(q.b, p.a), max(q.b, p.a) + 1)
            gone = [k for k in between if lines[k]["edit_type"] == "del"]
            q.dropped += gone if len(gone) > r.kept_deletions else []
            q.b, q.pad[1], q.keep[1] = p.b, p.pad[1], p.keep[1]
        else:
            whole.append(p)
    out = []
    for p in whole:
        words = [lines[k]["ref"] for k in range(p.a, p.b + 1) if lines[k]["ref"] != EPS and k not in p.dropped]
        out.append((p.begin(), p.end(), " ".join([r.unknown] * bool(p.pad[0]) + words + [r.unknown] * bool(p.pad[1]))))
    return out


def random_utterance(rng, n):
    out, at = [], 0.0
    for _ in range(n):
        kind = rng.choices(["cor", "sil", "fix", "del", "ins", "sub", "noise", "oov"], [60, 10, 3, 4, 2, 3, 8, 2])[0]
        dur = 0.0 if kind == "del" else round(rng.choice([0.05, 0.2, 0.3, 0.6, 0.04]), 3) if kind not in ("sil", "noise") else rng.choice([0.05, 0.3, 0.8, 2.5, 4.0])
        word = rng.choice("abcdefgh")
        hyp, ref = {"cor": (word, word), "sil": (EPS, EPS), "fix": (word, word), "del": (EPS, word), "ins": (word, EPS), "sub": (word, "z"), "noise": ("noise", "noise"), "oov": ("<unk>", "q")}[kind]
        out.append({"start": round(at, 6), "dur": dur, "hyp": hyp, "ref": ref, "edit_type": {"noise": "cor", "oov": "cor"}.get(kind, kind), "tainted": kind in ("sil", "noise", "fix", "oov") and rng.random() < 0.25})
        at += dur
    return out


def test_segments_against_plain_python(spark):
    rng = random.Random(4)
    utts = {u: random_utterance(rng, rng.choice([1, 2, 5, 12, 40, 120])) for u in range(150)}
    rows = [(u, i, x["start"], x["dur"], x["hyp"], x["ref"], x["edit_type"], x["tainted"]) for u, lines in utts.items() for i, x in enumerate(lines)]
    d = spark.createDataFrame(rows, "utt int, pos int, start double, dur double, hyp string, ref string, edit_type string, tainted boolean")
    for rules in (RULES, G.SegmentRules(unscored=("noise",), least_new=0.4, least=0.2, junk=0.3, kept_deletions=0)):
        got: dict = {}
        for r in sorted(G.segments_of(d, rules).collect(), key=lambda r: (r.utt, r.n)):
            got.setdefault(r.utt, []).append(r)
        wanted = {u: w for u, lines in utts.items() if (w := plain_segments(lines, rules))}
        assert got.keys() == wanted.keys() and sum(map(len, wanted.values())) > 100
        for u, segments in wanted.items():
            assert [r.text for r in got[u]] == [s[2] for s in segments]
            for r, (start, end, _) in zip(got[u], segments, strict=True):
                assert abs(r.start - start) <= 0.00501 and abs(r.end - end) <= 0.00501
            width = len(str(len(segments)))
            assert [r.segment for r in got[u]] == [f"{u}-{k:0{width}}" for k in range(1, len(segments) + 1)]


def plain_merge(words, pairs):
    out, i, j, now = [], 0, 0, words[0][0] if words else 0.0
    while i < len(pairs) or j < len(words):
        if i < len(pairs) and j < len(words) and pairs[i][0] == words[j][2] != EPS:
            out.append((*words[j][:2], *pairs[i]))
            now, i, j = words[j][0] + words[j][1], i + 1, j + 1
        elif i < len(pairs) and pairs[i][0] == EPS:
            out.append((words[0][0] if words and not any(w[2] != EPS for w in words[:j]) else now, 0.0, *pairs[i]))
            i += 1
        else:
            assert words[j][2] == EPS
            out.append((*words[j][:2], EPS, EPS))
            now, j = (now, j + 1) if False else (words[j][0] + words[j][1], j + 1)
    return out


def test_merged_edits(spark):
    rng = random.Random(5)
    words, pairs = {}, {}
    for u in range(60):
        told = [rng.choice("abc") for _ in range(rng.randint(0, 8))]
        words[u], pairs[u], at = [], [], 1.0
        for w in [*told, None]:
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[u].append((at, 0.25, EPS))
                at += 0.25
            if w:
                words[u].append((at, 0.5, w))
                at += 0.5
                pairs[u].append((w, rng.choice([w, w, "x", EPS])))
            pairs[u] += [(EPS, "gone")] * rng.choice([0, 0, 1, 2])
    t = spark.createDataFrame([(u, i, *w) for u, ws in words.items() for i, w in enumerate(ws)], "utt int, pos int, start double, dur double, word string")
    p = spark.createDataFrame([(u, i, *w) for u, ws in pairs.items() for i, w in enumerate(ws)], "utt int, pos int, hyp string, ref string")
    got: dict = {}
    for r in sorted(G.merged_edits(t, p).collect(), key=lambda r: (r.utt, r.pos)):
        got.setdefault(r.utt, []).append((r.start, r.dur, r.hyp, r.ref))
    wanted = {u: w for u in words if (w := plain_merge(words[u], pairs[u]))}
    assert got == wanted
    with pytest.raises(Exception, match="words and edits differ in 1"):
        G.merged_edits(spark.createDataFrame([(1, 0, 0.0, 1.0, "a")], t.schema), spark.createDataFrame([(1, 0, "b", "b")], p.schema)).collect()


def plain_local(ref, hyp, c, s, d, i, whole):
    """The table cell by cell, and the way back."""
    least = -(len(hyp) + 2) if whole else 0
    best = {(a, b): 0 for a in range(len(ref) + 1) for b in range(len(hyp) + 1)}
    back: dict = {}
    if whole:
        for b in range(1, len(hyp) + 1):
            best[0, b], back[0, b] = best[0, b - 1] - i, (0, b - 1)
    top, end = None, None
    for a in range(1, len(ref) + 1):
        for b in range(1, len(hyp) + 1):
            now, way = least, None
            pair = best[a - 1, b - 1] + (c if ref[a - 1] == hyp[b - 1] else -s)
            if pair >= now if whole else pair > 0:
                now, way = pair, (a - 1, b - 1)
            for cost, cell in ((d, (a - 1, b)), (i, (a, b - 1))):
                if best[cell] - cost > now:
                    now, way = best[cell] - cost, cell
            best[a, b] = now
            if way:
                back[a, b] = way
            if (not whole or b == len(hyp)) and (top is None or now >= top):
                top, end = now, (a, b)
    out = []
    while end in back and (end[1] or not whole):
        cell = back[end]
        out.append((cell[0] if cell[0] < end[0] else None, cell[1] if cell[1] < end[1] else None))
        end = cell
    return out[::-1], top or 0, end == (0, 0)


def test_local_words_against_plain_table():
    rng = random.Random(6)
    for _ in range(400):
        ref, hyp = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        scores = rng.choice([(1, 1, 1, 1), (2, 1, 1, 3), (3, 2, 2, 1)])
        for whole in (False, True):
            want, top, corner = plain_local(ref, hyp, *scores, whole)
            assert kernels.local_words(ref, hyp, *scores, whole, True) == (want, top)
            short = want[1:] if corner else want
            assert kernels.local_words(ref, hyp, *scores, whole)[0] == short


def test_locally_aligned_lines(spark):
    words = [(0.0, 0.4, "b"), (0.5, 0.4, "x"), (1.0, 0.4, EPS), (1.5, 0.4, "d"), (2.0, 0.3, "q")]
    d = spark.createDataFrame([(1, "a b c d".split(), words), (2, None, None), (3, ["a"], None)], "k int, ref array<string>, words array<struct<start:double,dur:double,word:string>>")
    got = {r.k: [tuple(x) for x in r.lines] for r in d.select("k", G.locally_aligned(d, "ref", "words", correct=3).alias("lines")).collect()}
    assert got[1] == [(0.0, 0.4, "b", "b", "cor"), (0.5, 0.4, "x", EPS, "ins"), (0.9, 0.0, EPS, "c", "del"), (1.0, 0.4, EPS, EPS, "sil"), (1.5, 0.4, "d", "d", "cor"), (2.0, 0.3, "q", EPS, "ins")]
    assert got[2] == [] and got[3] == []
    d = spark.createDataFrame([(1, "z a b c".split(), [(0.0, 0.4, "a"), (0.5, 0.1, EPS), (1.0, 0.4, "c")])], "k int, ref array<string>, words array<struct<start:double,dur:double,word:string>>")
    assert [tuple(x) for x in d.select(G.locally_aligned(d, "ref", "words", correct=3).alias("x")).first().x] == [(0.0, 0.4, "a", "a", "cor"), (0.4, 0.0, EPS, "b", "del"), (0.5, 0.1, EPS, EPS, "sil"), (1.0, 0.4, "c", "c", "cor")]


def test_long_recordings(spark, tmp_path):
    """Passages of imprecise transcripts are found again: recall of spoken words, and texts that are what was said."""
    from corpusflow.plans import longform

    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(600)]
    words, transcripts = [], []
    for rec in range(4):
        said = rng.choices(vocabulary, k=700)
        told = list(said)
        for i in range(0, len(told), 90):
            told[i] = "wrong"
        del told[300:310]
        told = rng.choices(vocabulary, k=150) + told + rng.choices(vocabulary, k=150)
        words += [(f"r{rec}", round(0.4 * i, 3), 0.35, w) for i, w in enumerate(said)]
        transcripts.append((f"r{rec}", " ".join(told)))
    w = spark.createDataFrame(words, "recording string, start double, dur double, word string")
    t = spark.createDataFrame(transcripts, "recording string, text string")
    got = longform.segmented(spark, w, t, str(tmp_path), longform.LongForm(document_words=150))
    r = longform.recall(got, w).first()
    assert r.spoken == 2800 and r.found >= 0.9 * r.spoken
    by = {}
    for rec, start, dur, word in words:
        by.setdefault(rec, []).append((start + dur / 2, word))
    right = total = 0
    for s in got.collect():
        spoken = [x for m, x in by[s.recording] if s.start <= m <= s.end]
        text = [x for x in s.text.split() if x != "<unk>"]
        right, total = right + sum(x in spoken for x in text), total + len(text)
    assert right >= 0.97 * total


def test_models_of_windows_reach_the_decoder(spark, tmp_path):
    from corpusflow.plans import longform

    seen = {}

    def decode(heard, models):
        seen["keys"] = {(r.query.recording, r.query.window) for r in models.select("query").distinct().collect()}
        return heard

    words = spark.createDataFrame([("a", 0.5 * i, 0.4, f"w{i}") for i in range(100)], "recording string, start double, dur double, word string")
    text = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(100)))], "recording string, text string")
    got = longform.segmented(spark, words, text, str(tmp_path), longform.LongForm(document_words=40, decode=decode)).collect()
    assert seen["keys"] == {("a", 0), ("a", 1)} and " ".join(r.text for r in got).replace("<unk> ", "").startswith("w0 w1 w2")

import json

import numpy as np
from pyspark.sql import functions as F

from corpusflow.functions import audio
from corpusflow.functions import kernels as K
from corpusflow.operators import edits as E
from corpusflow.operators import lm
from corpusflow.plans import stages
from corpusflow.streaming import manifests


def test_utterance_edits(spark):
    d = spark.createDataFrame([("a b c d e f", "x a b d e g")], "ref string, hyp string")
    r = d.withColumn("ops", E.aligned_words(d, "ref", "hyp")).select("ops", E.edit_counts(F.col("ops")).alias("n")).first()
    assert tuple(r.n) == (4, 1, 1, 1) and [x.op for x in r.ops] == ["I", "C", "C", "D", "C", "C", "S"]


def test_word_distance(spark):
    rows = [("a b c", "a c"), ("x", "y z"), ("", "q"), ("same words here", "same words here")]
    d = spark.createDataFrame(rows, "a string, b string").select(F.split("a", " ").alias("a"), F.split("b", " ").alias("b"))
    assert [r.d for r in d.select(E.word_distance(F.col("a"), F.col("b")).alias("d")).collect()] == [K.edit_distance(a.split(" "), b.split(" ")) for a, b in rows]


def test_word_distance_beyond_the_surrogates(spark):
    """More distinct words than there are characters before the surrogates' block."""
    a = F.transform(F.sequence(F.lit(1), F.lit(56_000)), lambda i: F.concat(F.lit("w"), i.cast("string")))
    d = spark.range(1).select(a.alias("a"))
    assert d.select(E.word_distance(F.col("a"), F.slice("a", 55_991, 9)).alias("d")).first().d == 55_991


def test_overlap_goes_to_the_better(spark):
    d = spark.createDataFrame([("r", "u1", 0.0, 10.0, 1, 10), ("r", "u2", 8.0, 20.0, 5, 10), ("r", "u3", 18.0, 30.0, 0, 10)], "recording string, utt string, start double, end double, errors int, words int")
    assert {r.utt: (r["from"], r.to) for r in E.better_halves(d).collect()} == {"u1": (0.0, 10.0), "u2": (10.0, 18.0), "u3": (18.0, 30.0)}


def test_cores(spark):
    rows = [("u", 0, 0.0, 1.0, "a", "cor", False), ("u", 1, 1.0, 1.0, "b", "cor", False), ("u", 2, 2.0, 1.0, "c", "sub", False), ("u", 3, 3.0, 1.0, "d", "cor", False)]
    d = spark.createDataFrame(rows, "utt string, pos int, start double, dur double, ref string, edit_type string, tainted boolean")
    assert sorted((r.start, r.end, r.text) for r in E.clean_cores(d).collect()) == [(0.0, 2.05, "a b"), (2.95, 4.05, "d")]


def test_forgiven(spark):
    d = spark.createDataFrame([("uh", None, "ins"), ("x", "y", "sub")], "hyp string, ref string, edit_type string")
    assert [tuple(r) for r in E.forgiven(d, ["uh"]).collect()] == [("uh", "uh", "fix"), ("x", "y", "sub")]


def test_stitched_worked_example(spark):
    docs = spark.createDataFrame([("doc1", ["A", "B", "C"]), ("doc2", ["D", "E"])], "doc string, words array<string>")
    s = spark.createDataFrame([("q1", 0, "doc1", 0.0, 0.0), ("q1", 1, "doc2", 0.0, 0.0)], "query string, place int, doc string, first double, last double")
    assert E.stitched(s, docs).first().text == "A B C D E"


def test_perturbed(spark):
    d = spark.createDataFrame([("u", 9.0)], "utt string, dur double")
    rows = {r.name: r for r in E.perturbed(d, "utt", "dur", volumes=(0.5, 2.0)).collect()}
    assert set(rows) == {"sp0.9-u", "u", "sp1.1-u"} and rows["sp0.9-u"].dur == 10.0 and all(0.5 <= r.volume <= 2 for r in rows.values())


def test_bpe(spark):
    counts = {"low": 5, "lower": 2, "newest": 6, "widest": 3}
    merges = lm.learn_merges(counts, 4)
    assert merges[0] in {("e", "s"), ("s", "t</w>")} and len(merges) == 4

    def slow(counts, k):
        split, out = {w: (*w[:-1], w[-1] + lm.END) for w in counts}, []
        for _ in range(k):
            pairs = {}
            for w, s in split.items():
                for p in zip(s, s[1:], strict=False):
                    pairs[p] = pairs.get(p, 0) + counts[w]
            best = max(pairs, key=lambda p: (pairs[p], p))
            if pairs[best] < 2:
                break
            out.append(best)
            split = {w: lm.joined(s, best) for w, s in split.items()}
        return out

    assert lm.learn_merges(counts, 10) == slow(counts, 10)
    d = spark.createDataFrame([("low newest low",), (None,)], "t string")
    out = [r.x for r in d.select(lm.apply_bpe(d, "t", merges).alias("x")).collect()]
    assert out[1] is None and out[0].replace("@@ ", "") == "low newest low"


def test_bpe_counts_all_words(spark, small_data, monkeypatch):
    from collections import Counter

    from corpusflow.plans.queries import QUERIES

    docs = spark.read.parquet(f"{small_data}/documents.parquet")
    counts = Counter(w for r in docs.collect() for w in (r.text or "").split())
    assert len(counts) > 5000
    merges = lm.learn_merges(counts, 200)
    bench = spark.read.parquet(f"{small_data}/benchmark.parquet")
    want = {r.item_id: r.x for r in bench.select("item_id", lm.apply_bpe(bench, "text", merges).alias("x")).collect()}
    assert {r.item_id: r.text for r in QUERIES["subword_texts"](spark, small_data).collect()} == want
    odd = Counter({"aaaaaaa": 9, "aaaa": 4, "abab</w>": 5, "a</w>b": 5, "ab\x00a": 3, "é😀é😀": 7, "babab": 5, "z": 2, "cab": 5, "bca": 5})
    monkeypatch.setattr(lm, "RANKED", 3)
    monkeypatch.setattr(lm, "KEPT_STEPS", 2)
    few = spark.createDataFrame([(" ".join([w] * n),) for w, n in odd.items()], "t string")
    assert lm.learn_bpe(few, "t", 40) == lm.learn_merges(odd, 40)


def test_sentence_scores(spark):
    rows = [(1, "<s>", -99.0, -0.5), (1, "a", -1.0, -0.25), (1, "</s>", -1.5, 0.0), (1, "<unk>", -3.0, 0.0), (2, "<s> a", -0.25, 0.0)]
    model = spark.createDataFrame(rows, "order int, gram string, logp double, backoff double")
    d = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    assert [r.p for r in d.select(lm.score_sentences(d, "t", model).alias("p")).collect()] == [-0.25 - 0.25 - 1.5, -0.5 - 3.0 - 1.5, None]


def test_audio(spark):
    rate = 16000
    tone = np.sin(np.arange(rate) * 2 * np.pi * 440 / rate) * 0.5
    wav = audio.make_wav(np.concatenate((np.zeros(rate), tone, np.zeros(rate))))
    assert audio.wav_info(wav) == (rate, 1, 2, 3.0) and audio.wav_info(b"x") is None
    (piece,) = audio.slices(wav, [(1000, 2000)])
    assert audio.wav_info(piece)[3] == 1.0
    d = spark.createDataFrame([(wav,), (b"no",)], "content binary")
    r = d.select(audio.info_column(d).alias("i"), audio.voice_column(d).alias("v")).collect()
    assert r[0].i.seconds == 3.0 and r[1].i is None and r[1].v is None
    (a,), (b,) = r[0].v.start_ms, r[0].v.end_ms
    assert 700 <= a <= 1000 and 2000 <= b <= 2400


def test_corpus_stages(spark, tmp_path):
    item = {"identifier": "talk", "files": [{"name": "x.mp3", "size": "9", "format": "MP3"}, {"name": "x.srt", "size": "9", "format": "SubRip"}], "metadata": {"licenseurl": "by/4.0"}}
    (tmp_path / "c.json").write_text(json.dumps(item) + "\n")
    (tmp_path / "ctm").mkdir()
    (tmp_path / "ctm" / "talk-x.mp3.ctm").write_text("u 1 0.0 1.0 hello 1\nu 1 1.0 1.0 there 1\nu 1 2.0 1.0 world 1\n")
    (tmp_path / "srt" / "talk").mkdir(parents=True)
    (tmp_path / "srt" / "talk" / "x.srt").write_text("1\n00:00:00,000 --> 00:00:03,000\nHello there\nworld!\n")
    (tmp_path / "held.json").write_text(json.dumps({"identifier": "other", "text_document_id": "y"}) + "\n")
    c = stages.Corpus(str(tmp_path / "c.json"), str(tmp_path / "ctm"), str(tmp_path / "srt"), held_out=[str(tmp_path / "held.json")])
    s = stages.corpus_stages(c)
    stages.run(spark, s, str(tmp_path / "out"), 0, 2)
    r = stages.run(spark, s, str(tmp_path / "out"), 3).collect()
    assert [(x.text, x.duration) for x in r] == [("hello there world", 3.0)]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = {"identifier": "i", "audio_document_id": "a", "text_document_id": "t", "training_data": {"duration_ms": [1500], "label": ["x"], "name": ["n"]}}
    (tmp_path / "in" / "1.json").write_text(json.dumps(row) + "\n")
    manifests.append_batches(manifests.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert [(r.text, r.duration) for r in spark.read.json(str(tmp_path / "out")).collect()] == [("x", 1.5)]
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a")], "t string, k string").withColumn("t", F.to_timestamp("t"))
    assert manifests.windowed_counts(events, "t", "k").first().n == 2 and manifests.sessions(events, "t", "k").count() == 2


def test_annotate(spark):
    assert stages.annotate(spark.range(1), {"lang": "en"}).first().lang == "en"
    assert stages.catalogue_of([spark.createDataFrame([("/r/a", "/x/b")], "audio string, text string")], "/r", ["audio"]).first().audio == "a"


def test_scores_by_joins(spark):
    """Against the model in memory: n-grams that are there, back-off over two orders, unknown words, short histories."""
    import random

    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "d", "</s>"]
    rows = [(1, w, -rng.uniform(0.1, 2), -rng.uniform(0, 1)) for w in ["<s>", *vocabulary, "<unk>"]]
    rows += [(2, f"{x} {y}", -rng.uniform(0.1, 2), -rng.uniform(0, 1)) for x in ["<s>", *vocabulary[:4]] for y in vocabulary if rng.random() < 0.6]
    rows += [(3, f"{x} {y} {z}", -rng.uniform(0.1, 2), 0.0) for x in ["<s>", "a", "b"] for y in "abcd" for z in vocabulary if rng.random() < 0.5]
    model = spark.createDataFrame(rows, "order int, gram string, logp double, backoff double")
    texts = [(k, " ".join(rng.choices(["a", "b", "c", "d", "zebra"], k=rng.randint(1, 9)))) for k in range(40)] + [(99, "")]
    d = spark.createDataFrame(texts, "k int, t string")
    got = {r.k: r.logp for r in lm.joined_scores(d, "k", "t", model, 3).collect()}
    table = {tuple(g.split(" ")): (p, b) for _, g, p, b in rows}
    want = {k: lm.sentence_logprob(table, t.split(), 3) for k, t in texts}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def greedy_merge(durations, least):
    """The rule on one list, with sets of neighbours instead of positions in a list of pieces."""
    less = lambda x, y: x < y - 1e-5
    groups = {i: [i] for i in range(len(durations))}
    total = lambda g: sum(durations[i] for i in g)
    owner = dict(enumerate(range(len(durations))))
    todo = [i for i in range(len(durations)) if less(durations[i], least)]
    while todo:
        k = todo.pop()
        if k not in groups or not less(total(groups[k]), least):
            continue
        first, last = groups[k][0], groups[k][-1]
        left = groups[owner[first - 1]] if first else None
        right = groups[owner[last + 1]] if last + 1 < len(durations) else None
        if left is None and right is None:
            break
        own = total(groups[k])
        to_left = right is None or (left is not None and not less(total(left) + own, least) and (less(total(right) + own, least) or less(total(left), total(right))))
        a, b = (left[0], k) if to_left else (k, right[0])
        groups[a] += groups.pop(b)
        owner |= dict.fromkeys(groups[a], a)
        if not to_left:
            todo.append(k)
    return [(g[0], g[-1] + 1) for _, g in sorted(groups.items())]


def test_combined_across_speakers(spark):
    import random

    from corpusflow.operators import sequences as S

    rng = random.Random(8)
    for short in (0.2, 0.6, 1.0):
        rows = []
        for k in range(120):
            whole = rng.random() < short
            rows += [(f"s{k:03}", f"s{k:03}-{i}", round(rng.uniform(0.1, 0.9 if whole else 4), 2)) for i in range(rng.randint(1, 2 if whole else 4))]
        want, groups = [], []
        for spk in sorted({r[0] for r in rows}):
            own = sorted(r for r in rows if r[0] == spk)
            groups += [own[a:b] for a, b in greedy_merge([r[2] for r in own], 2.0)]
        for a, b in greedy_merge([sum(r[2] for r in g) for g in groups], 2.0):
            members = [r for g in groups[a:b] for r in g]
            by = {}
            for r in members:
                by[r[0]] = by.get(r[0], 0) + r[2]
            most = max(by.values())
            ids = [r[1] for r in members]
            want.append((ids[0] if len(ids) == 1 else f"{ids[0]}-comb{len(ids)}", min(s for s, d in by.items() if d >= most - 1e-5), ids))
        d = spark.createDataFrame(rows, "speaker string, utt string, dur double").repartition(3)
        got = [(r.name, r.speaker, r.members) for r in S.combine_across_speakers(d, 2.0).collect()]
        assert sorted(got) == sorted(want) and len({s for _, s, m in want if len(m) > 1}) > 5


def plain_kn(lines, order):
    """{gram: (f, weight)} by dictionaries of histories, one n-gram at a time."""
    count, before = {}, {}
    for line in lines:
        w = ["<s>", *line.lower().split(), "</s>"]
        for i in range(len(w)):
            for n in range(1, order + 1):
                if i + n <= len(w):
                    g = tuple(w[i : i + n])
                    count[g] = count.get(g, 0) + 1
                    if i:
                        before.setdefault(g, set()).add(w[i - 1])
    f, weight = {}, {}
    for n in range(1, order + 1):
        own = {g: c for g, c in count.items() if len(g) == n}
        n1, n2 = (sum(c == k for c in own.values()) for k in (1, 2))
        d = n1 / (n1 + 2 * n2) if n > 1 else 0.0
        for g in own:
            same = [x for x in own if x[:-1] == g[:-1]]
            kinds = sum(len(before.get(x, ())) for x in same)
            if n < order and kinds:
                f[g] = max(0.0, len(before.get(g, ())) - d) / kinds
            else:
                f[g] = (own[g] - d) / sum(own[x] for x in same)
        for h in {g[:-1] for g in own} if n > 1 else ():
            after = [g for g in own if g[:-1] == h]
            a, b = 1 - sum(f[g] for g in after), 1 - sum(f[g[1:]] for g in after)
            if b <= 1e-12:
                f |= {g: f[g] / (1 - a) for g in after}
            elif a > 1e-12:
                weight[h] = a / b
    return f, weight


def test_kn_model_of_any_order(spark):
    import math
    import random

    from corpusflow.operators import lm

    rng = random.Random(11)
    lines = [" ".join(rng.choices("a b c d e f".split(), [9, 5, 3, 2, 1, 1], k=rng.randint(0, 12))) for _ in range(60)]
    d = spark.createDataFrame([(x,) for x in lines], "text string")
    for order in (2, 3, 4):
        f, weight = plain_kn(lines, order)
        rows = {tuple(r.gram.split(" ")): r for r in lm.kn_model(d, "text", order).collect()}
        assert rows.keys() == f.keys()
        for g, r in rows.items():
            assert abs((10**r.logp if r.logp > -99 else 0.0) - f[g]) < 1e-9
            assert (r.backoff is not None) == (g in weight) and (g not in weight or abs(10**r.backoff - weight[g]) < 1e-9)

        def p(history, w):
            g = (*history, w)
            return 10 ** rows[g].logp if g in rows and rows[g].logp > -99 else 10 ** (rows[history].backoff or 0.0) * p(history[1:], w) if history else 0.0

        vocabulary = [g[0] for g in rows if len(g) == 1 and g[0] != "<s>"]
        for h in {g[:-1] for g in rows if len(g) > 1}:
            assert math.isclose(sum(p(h, w) for w in vocabulary), 1, abs_tol=1e-6)


def test_overlaps_in_buckets(spark):
    import random

    from corpusflow.operators import relational as R

    rng = random.Random(12)
    spans = lambda n: [(rng.choice("ab"), a := round(rng.uniform(-50, 50), 2), round(a + rng.choice([0, 0.5, 3, 3, 60]), 2)) for _ in range(n)]
    x, y = spans(120), spans(150)
    frame = lambda rows: spark.createDataFrame(rows, "file string, start double, end double")
    got = sorted((r.file, r.h_start, r.h_end, r.r_start, r.r_end) for r in R.overlap(frame(x), frame(y)).collect())
    assert got == sorted((k, a, b, c, d) for k, a, b in x for q, c, d in y if k == q and a < d and c < b)
    assert R.overlap(frame(x), frame([])).count() == 0

"""What keeps large tables within bounds: rows folded as they come in, audio made in pieces, choices looked up in parts."""

import bisect
import math
from decimal import Decimal
from pathlib import Path

import numpy as np

from corpusflow.functions import audio
from corpusflow.operators import augment as A
from corpusflow.operators import sequences as S
from corpusflow.plans.queries import QUERIES
from corpusflow.sources import archives


def plan(df):
    return df._jdf.queryExecution().toString()


def plan(df):
    return df._jdf.queryExecution().toString()


def test_voice_of_recordings_in_pieces(spark, small_data):
    rng = np.random.default_rng(5)
    whole = [np.repeat(rng.random(n) < 0.5, 1000) * 0.5 * np.sin(np.arange(n * 1000) / 5) for n in (1, 40, 300)]
    spans = [(k, audio.voiced_spans(audio.loud_frames(audio.make_wav(x)))) for k, x in enumerate(whole)]
    for size in (333, 480, 5000):
        pieces = ((k, audio.make_wav(x[a : a + size])) for k, x in enumerate(whole) for a in range(0, len(x), size))
        assert list(audio.voiced_recordings(pieces)) == spans
    d = QUERIES["voiced_sections"](spark, small_data)
    assert "collect_list" not in plan(d)
    events = sorted((r.user_id, r.ts, r.event_id, r.event_type in ("click", "view")) for r in spark.read.parquet(f"{small_data}/events.parquet").collect())
    users = {}
    for user, _, _, loud in events:
        users.setdefault(user, []).extend([loud] * 10)
    want = {u: audio.voiced_spans(np.array(v)) for u, v in users.items()}
    assert {r.user_id: list(zip(r.start_ms, r.end_ms, strict=True)) for r in d.collect()} == want


def test_speakers_are_cut_as_their_rows_come_in(spark):
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else f"s{i % 40}", int(k), float(d)) for i, (k, d) in enumerate(zip(rng.permutation(30_000), rng.integers(1, 50, 30_000), strict=True))]
    got = S.split_speakers_by_seconds(spark.createDataFrame(rows, "speaker string, utt long, dur double").repartition(7), "speaker", "utt", "dur", 300.0)
    assert "collect_list" not in plan(got)
    want, state = set(), {}
    for who, k, d in sorted(rows):
        part, held = state.get(who, (0, 0.0))
        state[who] = (part + 1, d) if held and held + d > 300 else (part, held + d)
        want.add((who, k, f"{who}-{state[who][0]:03d}"))
    assert {tuple(r) for r in got.collect()} == want


def test_recordings_of_any_length_are_converted(spark, tmp_path):
    rows = [(k, 1, float(q)) for k, q in ((1, 10), (2, 1000), (5, 10), (6, 126))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.line.split()[0] for r in QUERIES["unfinished_recordings"](spark, str(tmp_path)).collect()}
    assert got == {"rec1", "rec2", "rec6"}
    d = spark.createDataFrame([("a", "/a", 5.0), ("b", "/b", 6.0), ("c", "/c", 4.0)], "name string, path string, bytes double")
    archives.write_scp(d, d.filter("name = 'c'").select("name"), f"{tmp_path}/scp", "cat {} |", 5)
    assert [r.value for r in spark.read.text(f"{tmp_path}/scp").collect()] == ["a cat /a |"]  # the operator's own gate


def test_audio_is_made_in_pieces(spark, small_data):
    for name in ("wave_headers", "audio_chunks"):
        assert "ArrowEvalPython" not in plan(QUERIES[name](spark, small_data))  # no column of audio of 10,000 rows


def test_choices_from_many_items(spark):
    n = 6_000
    weights = [(i * 37 % 50 + 1) / 1e6 for i in range(n)]
    items = spark.createDataFrame([(i, f"r{i % 2}", w) for i, w in enumerate(weights)], "rir long, room string, probability double").repartition(5)
    rooms = A.smoothed(items).persist()
    told = {r.rir: r.probability for r in rooms.collect()}
    assert all(told[i] == w / math.fsum(weights) for i, w in enumerate(weights))  # to the last bit, however the rows lie
    exact, ends = Decimal(0), []
    for i in range(n):
        exact += Decimal(repr(told[i])).quantize(Decimal(10) ** -26)
        ends.append(float(exact))
    asked = spark.createDataFrame([(k, x) for k, x in enumerate([0.0, 0.25, 0.999999999, *ends[: n - 1 : 7]])], "k int, u double")
    got = {r.k: r.rir for r in A.picked(asked, "u", rooms, "rir").collect()}
    assert got == {r.k: min(bisect.bisect_right(ends, r.u), n - 1) for r in asked.collect()}
    wet = spark.range(3000).selectExpr("concat('x', id) AS name", "concat('r', id % 2) AS room", "100.0D AS dur")
    noises = spark.createDataFrame([("n", "foreground", 1.0)], "noise string, kind string, probability double")
    d = A.noises_added(wet, noises, rooms, [1.0], [1.0])
    assert "BroadcastNestedLoopJoin" not in plan(d) and len({(r.name, r.k) for r in d.collect()}) == d.count()


def test_model_levels_are_written_once(spark):
    from corpusflow.operators import lm

    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.glob("table-*"))
    model = lm.kn_model(spark.createDataFrame([("a b c a b",), ("b c",)], "text string"), "text", 2)
    assert len(set(root.glob("table-*")) - before) == 5  # counts and levels of two orders, and the higher one beside the lower
    assert {(r.order, r.gram) for r in model.filter("order = 2").collect()} >= {(2, "<s> a"), (2, "a b"), (2, "c </s>")}
    assert model.filter("order = 1 AND gram = 'a' AND backoff IS NOT NULL").count() == 1

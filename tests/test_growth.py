"""What grows with the input: tasks, Python objects at once, work for each group."""

import math
from collections import Counter

import pytest

from corpusflow.functions import kernels as K
from corpusflow.operators import corpus as C
from corpusflow.plans.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_letter_pairs_are_dealt_to_all_tasks(spark, small_data):
    """Few rows of long work would else be put together to one task (F9)."""
    assert "REPARTITION_BY_NUM" in plan_of(QUERIES["letter_confusions"](spark, small_data))


def test_alignment_scores_cell_by_cell():
    import random

    rng = random.Random(9)
    for _ in range(60):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in "ab")
        want = [[-2 * (i + j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                ways = [want[i - 1][j - 1] + (3 if a[i - 1] == b[j - 1] else -1), want[i - 1][j] - 2, 0]
                want[i][j] = max(ways + ([want[i][j - 1] - 2] if j > 1 else []))
        assert K.alignment_scores(K._letters(a), K._letters(b), 3, -1, -2).tolist() == want


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A folder for each file, and not a task for each folder (F2)."""
    from corpusflow.sources import text_formats as T

    for i in range(60):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a.txt").write_text("x")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    spark.sparkContext.setJobGroup("listing", "listing")
    found = T.files(spark, str(tmp_path), content=False)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max((s.numTasks for s in stages if s), default=0) <= 4
    assert found.count() == 60 and spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before


def test_rows_through_python_a_slice_at_a_time():
    """Objects of a slice are there at once, whatever the batch holds (F13, F18)."""
    import pyarrow as pa

    from corpusflow.functions.arrow import by_row

    class Row(list):
        now = most = 0

        def __init__(self, x):
            super().__init__([x])
            Row.now += 1
            Row.most = max(Row.most, Row.now)

        def __del__(self):
            Row.now -= 1

    rows = pa.array(range(1000))
    got = by_row(lambda x, y: Row(x + y), pa.list_(pa.int64()), rows, rows, rows=50)
    assert got.to_pylist() == [[2 * x] for x in range(1000)] and Row.most <= 100
    assert by_row(Row, pa.list_(pa.int64()), rows[:0]).type == pa.list_(pa.int64())


@pytest.mark.parametrize("name", ["locally_aligned_turns", "utterance_edits"])
def test_turns_are_dealt_to_all_tasks(spark, small_data, name):
    assert "REPARTITION_BY_NUM" in plan_of(QUERIES[name](spark, small_data))


def test_aligned_words_of_empty_texts(spark):
    from corpusflow.operators import edits

    d = spark.createDataFrame([("a b", "a c"), (None, "x"), ("", None)], "ref string, hyp string").coalesce(1)
    got = [[tuple(x) for x in r[0]] for r in d.select(edits.aligned_words(d, "ref", "hyp")).collect()]
    assert got == [[("a", "a", "C"), ("b", "c", "S")], [(None, "x", "I")], []]


def test_pairs_are_compared_once(spark, monkeypatch):
    """Names come again and again (F17)."""
    import time

    from corpusflow.operators import edits

    monkeypatch.setitem(K.SIMILARITIES, "now", lambda x, y: time.perf_counter())
    d = spark.range(60).selectExpr("'a' AS x", "CAST(id % 2 AS STRING) AS y").coalesce(1)
    assert len({r[0] for r in d.select(edits.similarities(d, "x", "y", ["now"])["now"]).collect()}) == 2


def test_weights_of_places_are_made_once(monkeypatch):
    """A fragment against texts of like length (F23)."""
    made, of = [], K.place_weights
    monkeypatch.setattr(K, "place_weights", lambda *a: made.append(a) or of(*a))
    for i in range(20):
        K.ngram_similarity("some words of a fragment", f"other words in {i:02} a text")
    assert len(made) <= 6


@pytest.mark.parametrize("name", ["combined_utterances", "stable_matching"])
def test_groups_go_through_arrow_in_all_tasks(spark, small_data, name):
    """A data frame for each of many small groups takes longer than its work (F16, F22)."""
    plan = plan_of(QUERIES[name](spark, small_data))
    assert "FlatMapGroupsInArrow" in plan and "REPARTITION_BY_NUM" in plan


def test_combined_utterances_in_one_order(spark):
    """Rows of one key by duration, however they come in (F16, F19)."""
    from corpusflow.operators.sequences import combine_utterances

    rows = [("s", f"u{i % 7}", float(d)) for i, d in enumerate([3, 9, 1, 4, 12, 6, 2, 8, 5, 7, 11, 10, 13, 0])]
    got = [sorted(map(tuple, combine_utterances(spark.createDataFrame(r, "speaker string, utt string, dur double"), 10.0).select("name", "dur").collect())) for r in (rows, rows[::-1])]
    assert got[0] == got[1] and sum(d for _, d in got[0]) == 91


def test_matching_of_one_sided_items(spark):
    from corpusflow.operators.alignment import match_documents

    a = spark.createDataFrame([("i", "x1"), ("i", "x2"), ("j", "y")], "identifier string, audio_document_id string")
    b = spark.createDataFrame([("i", "x2.txt"), ("k", "z")], "identifier string, text_document_id string")
    assert [tuple(r) for r in match_documents(a, b).collect()] == [("i", "x2", "x2.txt")]


def test_more_pages_give_more_archives(spark, tmp_path, monkeypatch):
    """No archive, which is one task's work, grows with the table (F11)."""
    from corpusflow.plans import formats

    monkeypatch.setattr(formats, "folder", lambda spark: str(tmp_path / "warc"))
    spark.range(2600).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "concat('<p>', id, '</p>') AS html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    assert QUERIES["web_archives"](spark, str(tmp_path)).distinct().count() == 2600
    counts = [f.read_text().count("WARC-Type: response") // 2 for f in (tmp_path / "warc").glob("*.txt")]
    assert sum(counts) == 2600 and max(counts) <= 500


def test_stages_of_long_recordings_broadcast_nothing_that_grows(spark, monkeypatch):
    """(F4)"""
    from corpusflow.plans import longform

    d = spark.range(5)
    run = lambda *_: plan_of(d.join(spark.range(3), "id"))
    monkeypatch.setattr(longform, "run", run)
    words = spark.createDataFrame([], "recording long, start double, dur double, word string")
    inside = longform.segmented(spark, words, words.select("recording", "word"), "unused")
    assert "BroadcastHashJoin" not in inside and "BroadcastHashJoin" in run()


def test_counted_terms_are_not_shuffled(spark):
    """Texts are, once, by their document (F20)."""
    from corpusflow.operators import corpus as C

    d = spark.createDataFrame([(1, "a b a"), (2, "b"), (1, "b c")], "k long, t string")
    counts = C.term_counts(d, "k", "t")
    assert not [x for x in plan_of(counts).splitlines() if "Exchange" in x and "term" in x]
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 2), (1, "b", 2), (1, "c", 1), (2, "b", 1)]


def test_bm25_of_repeated_queries_and_documents_without_a_key(spark):
    """An item that is there twice counts once, parts of a document are put together, and documents without a key are one; only the best pairs leave a task."""
    docs = [(1, "a b b c"), (2, "B c\\td"), (2, "a x"), (3, ""), (4, None), (5, "a b b c"), (None, "a a q"), (None, "b"), (6, "zz"), *[(i, "b e " + "w " * (i % 4)) for i in range(10, 40)]]
    asked = [(1, "a b"), (1, "b A"), (2, "c nowhere"), (None, "d zz"), (3, " "), (4, "b b e")]
    found = C.bm25(spark.createDataFrame(asked, "item int, text string"), spark.createDataFrame(docs, "id long, text string").repartition(3), "item", "text", "id", "text", 3)
    counts, queries = {}, {}
    for i, t in docs:
        if (t or "").split():
            counts.setdefault(i, Counter()).update(t.lower().split())
    for i, t in asked:
        queries.setdefault(i, set()).update(t.lower().split())
    df = Counter(t for c in counts.values() for t in c)
    mean = sum(c.total() for c in counts.values()) / len(counts)
    want = set()
    for i, terms in queries.items():
        score = {}
        for k, c in counts.items():
            if k is not None and terms & set(c):
                score[k] = round(sum(math.log(1 + (len(counts) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for t in terms if t in c), 6)
        want |= {(i, k, s, n) for n, (k, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:3], 1)}
    assert {(r.item, r.id, round(r.score, 6), r["rank"]) for r in found.collect()} == want


def test_bigrams_are_dealt_once_to_words_and_then_summed_up(spark, small_data):
    """Pairs were dealt to their histories, to their words and to their histories again (F21); sums are those of each pair's probability."""
    assert plan_of(QUERIES["kn_bigrams"](spark, small_data)).count("Exchange hashpartitioning") <= 4
    docs = spark.createDataFrame([("a b a b c",), ("A  b\nc d",), ("",), (None,), ("b a " * 6 + "d c",)], "text string")
    each, want = C.interpolated(C.kn_probabilities(C.kn_counts(docs, "text"))).collect(), {}
    for r in each:
        want.setdefault(r.history[0], []).append(r.p)
    got = {r.history: (r.words, r.mass, r.most) for r in C.interpolated_sums(docs, "text").collect()}
    assert got.keys() == want.keys()
    for h, p in want.items():
        assert got[h][0] == len(p) and got[h][1:] == pytest.approx((sum(p), max(p)), abs=1e-12)
    assert C.interpolated_sums(docs.limit(0), "text").collect() == []

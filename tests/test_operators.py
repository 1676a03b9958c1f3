import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import alignment as A
from corpusflow.operators import corpus as C
from corpusflow.operators import relational as R
from corpusflow.operators import sequences as S
from corpusflow.operators import splits as P


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return df.select(col.alias("v")).first().v


def test_filter_by_ids(spark):
    d = spark.createDataFrame([("foo", 1), ("bar", 2)], "k string, n int")
    ids = spark.createDataFrame([("foo",)], "k string")
    assert R.by_ids(d, ids, "k").collect() == [("foo", 1)]
    assert R.by_ids(d, ids, "k", exclude=True).collect() == [("bar", 2)]


def test_extended_worked_example(spark):
    d = spark.createDataFrame([("utt1", "r", 0.2, 6.2), ("utt2", "r", 6.3, 9.8)], "utt string, recording string, start double, end double")
    got = {r.utt: (round(r.start, 3), round(r.end, 3)) for r in S.extended(d).collect()}
    assert got == {"utt1": (0.1, 6.25), "utt2": (6.25, 9.9)}


def test_fragments_worked_example(spark):
    words = [(0, 5000, "a"), (5100, 9000, "b"), (9100, 16000, "c"), (25000, 26000, "d")]
    d = spark.createDataFrame([(words,), ([],)], "w array<struct<start_ms:bigint,end_ms:bigint,word:string>>")
    got = [[tuple(x) for x in r.f] for r in d.select(S.fragments(F.col("w")).alias("f")).collect()]
    assert got == [[(0, 9000, "a b"), (9100, 16000, "c"), (25000, 26000, "d")], []]


def test_speaker_table_worked_example(spark):
    d = spark.createDataFrame([("A", 3, 1, 1, 1)], "speaker string, c int, s int, i int, d int")
    rows = {r.speaker: r for r in C.speaker_table(d).collect()}
    assert set(rows) == {"A", "SUM"} and rows["A"].words == 5 and rows["A"].corr == 60 and rows["A"].sub == rows["A"].ins == 20


def test_token_map_worked_example(spark):
    d = spark.createDataFrame([(1, ["A", "B", "C"]), (2, [])], "k int, t array<string>")
    m = spark.createDataFrame([("A", "a1 a2"), ("B", "b")], "token string, to string")
    assert {r.k: r.t for r in R.map_tokens(d, "k", "t", m, "<UNK>").collect()} == {1: ["a1 a2", "b", "<UNK>"], 2: []}


def test_text_functions(spark):
    assert one(spark, X.clean_transcript(F.lit(" Don't  stop-now! É"))) == "don't stop now "
    srt = "1\n00:00:01,00 --> 00:00:02,59\nHello\nworld\n\n2\n00:00:03,000 --> 00:00:04,000\nagain\n"
    assert one(spark, X.srt_text(F.lit(srt))) == "Hello world again"
    assert one(spark, X.srt_text(F.lit("no cue"))) == ""
    assert one(spark, X.html_text(F.lit("<p>a  b</p><script>x()</script><div> c </div>"))) == "a\nb\nc"
    assert one(spark, X.plain(F.lit("Ça  va\nÉté — ß"))) == "ca va ete ss"
    assert one(spark, X.file_key(F.lit("a/b.c d"))) == "a_SLASH_b_DOT_c_SPACE_d"
    assert len(one(spark, X.file_key(F.lit("x" * 300)))) == 236
    assert one(spark, X.chunk_names(F.lit("k"), F.lit(2), "flac")) == ["k_00000.flac", "k_00001.flac"]
    assert one(spark, X.chunk_names(F.lit("k"), F.lit(0), "flac")) == []
    assert one(spark, X.licence_class(F.lit("http://x/by-sa/3.0"))) == "CC BY-SA"
    assert one(spark, X.licence_class(F.lit(None).cast("string"))) is None
    assert one(spark, X.byte_size(F.lit("1GB"))) == 1 << 30 and one(spark, X.byte_size(F.lit("x"))) is None
    assert one(spark, X.clock_ms(F.lit("1:02:03.5"))) == 3723500 and one(spark, X.clock_ms(F.lit("a:b"))) is None
    assert one(spark, X.ngrams(F.lit("abcd"), 3)) == ["abc", "bcd"] and one(spark, X.ngrams(F.lit("ab"), 3)) == []
    assert one(spark, X.with_key(F.lit('{"a":"1"}'), "b", F.lit(2))) == '{"a":"1","b":"2"}'
    assert one(spark, X.tail(F.lit("a/b/c.mp3"))) == "c.mp3" and one(spark, X.extension(F.lit("a/b/c.mp3"))) == "mp3"
    assert one(spark, X.stem(F.lit("a/b.c.wav"))) == "b.c" and one(spark, X.directory(F.lit("a/b/c"))) == "a/b"
    assert one(spark, X.guess_text(F.lit("é").cast("binary"))) == "é"
    assert one(spark, X.guess_text(F.unhex(F.lit("E9")))) == "é"


def test_usable_files(spark):
    d = spark.createDataFrame([("i", "a.mp3", "5", None), ("i", "b[1].mp3", "5", None), ("i", "c", "0", None), ("i", "d", "x", None), ("i", "e", "5", "true")], "identifier string, name string, size string, private string")
    assert [r.name for r in R.usable_files(d).collect()] == ["a.mp3"]


def test_overlap_resolution(spark):
    seg = spark.createDataFrame([("u1", "r", 0.0, 30.0), ("u2", "r", 25.0, 55.0)], "utt string, recording string, start double, end double")
    words = spark.createDataFrame([("u1", 26.0, 1.0, "a"), ("u1", 28.0, 1.0, "b"), ("u2", 1.0, 1.0, "a"), ("u2", 3.0, 1.0, "b")], "utt string, start double, dur double, word string")
    assert sorted((r.word, r.utt) for r in S.without_overlap(words, seg).collect()) == [("a", "u1"), ("b", "u2")]


def test_a_contained_segment_gives_no_word(spark):
    seg = spark.createDataFrame([("u1", "r", 0.0, 30.0), ("u2", "r", 10.0, 14.0), ("u3", "r", 28.0, 40.0)], "utt string, recording string, start double, end double")
    words = spark.createDataFrame([("u1", 5.0, 1.0, "a"), ("u1", 25.0, 1.0, "b"), ("u2", 2.0, 1.0, "x"), ("u3", 0.0, 1.0, "y"), ("u3", 5.0, 1.0, "c")], "utt string, start double, dur double, word string")
    assert sorted((r.start, r.word, r.utt) for r in S.without_overlap(words, seg).collect()) == [(5.0, "a", "u1"), (25.0, "b", "u1"), (33.0, "c", "u3")]


def test_numbered(spark):
    rows = [(i * 7 % 1000, i % 3) for i in range(1000)] + [(None, 5)]
    d = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = {r.k: (r.place, r.before) for r in R.numbered(d, ["k"], "place", "before", "v").collect()}
    want, total = {}, 0
    for n, (k, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        want[k] = (n, total)
        total += v
    assert got == want and R.numbered(d.limit(0), ["k"]).collect() == []
    assert R.numbered(d, ["v", "k"]).agg(F.count_distinct("place").alias("n"), F.max("place").alias("m")).first() == (1001, 1000)


def test_a_document_that_takes_too_long_is_marked(spark):
    words = " ".join(f"word{i}" for i in range(400))
    d = spark.createDataFrame([(1, [(0, 1, words)], words), (2, [], "x")], "k int, fragments array<struct<start:bigint,end:bigint,transcript:string>>, transcript string")
    slow = A.align_table(d, settings=A.Settings(seconds=0.001)).orderBy("k").collect()
    assert (slow[0].timed_out, slow[0].alignments) == (True, None)
    fine = A.align_table(d).orderBy("k").collect()
    assert [r.timed_out for r in fine] == [False, False] and fine[1].alignments.label == []


def test_splits_are_whole_and_pure(spark):
    d = spark.createDataFrame([(i, i % 7) for i in range(100)], "k int, e int")
    r = P.random_split(d, "k", 10, 20).groupBy("split").count().collect()
    assert {x["split"]: x["count"] for x in r} == {"test": 10, "dev": 20, "train": 70}
    e = P.entity_split(d, "e", 20, 30)
    assert e.count() == 100 and e.groupBy("e").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    rel = P.released_split(d.filter("k < 50"), d.filter("k >= 50 and k < 60"), d.filter("k >= 40"), "k", 10, 10)
    assert rel.groupBy("k").count().filter("count > 1").isEmpty()


def test_match_documents(spark):
    a = spark.createDataFrame([("i", "talk_1.mp3"), ("i", "talk_2.mp3"), ("i", "x.mp3")], "identifier string, audio_document_id string")
    b = spark.createDataFrame([("i", "talk_2.srt"), ("i", "talk_1.srt"), ("j", "z.srt")], "identifier string, text_document_id string")
    assert sorted((r.audio_document_id, r.text_document_id) for r in A.match_documents(a, b).collect()) == [("talk_1.mp3", "talk_1.srt"), ("talk_2.mp3", "talk_2.srt")]


def test_alignment_to_manifest(spark):
    d = spark.createDataFrame([("i", "a", "t", [(0, 4000, "hello there world"), (4000, 9000, "something else again")], "Hello there, world. Something else again!")], "identifier string, audio_document_id string, text_document_id string, fragments array<struct<start:bigint,end:bigint,transcript:string>>, transcript string")
    out = A.align_table(d)
    kept = A.kept_alignments(out, 0, 20, 1000, 20000)
    man = A.manifest(kept)
    flat = A.trainer_manifest(man).orderBy("audio_filepath").collect()
    assert [(r.text, r.duration, r.shard_id) for r in flat] == [("hello there world", 4.0, -1), ("something else again", 5.0, -1)]


def test_speech_segments(spark):
    labels = "ssnnnssns"
    d = spark.createDataFrame([("r", i, c) for i, c in enumerate(labels)], "key string, frame int, label string")
    got = sorted((r.start, r.end) for r in S.speech_segments(d, "key", 1.0, "s", 1.5, 0.5).collect())
    assert got == [(0.0, 2.5), (4.5, 7.5)]


def test_round_robin_and_shards(spark):
    d = spark.range(10).toDF("k")
    assert sorted(r["count"] for r in R.round_robin(d, ["k"], 3).groupBy("split").count().collect()) == [3, 3, 4]
    assert R.range_shards(d, "k", 335).rdd.getNumPartitions() == 1


def test_gates(spark):
    d = spark.createDataFrame([(1.0,), (5.0,), (9.0,)], "x double")
    assert {r.reason: r.n for r in R.gate_counts(d, {"x": (2, 8)}).collect()} == {"x too low": 1, "kept": 1, "x too high": 1}
    with pytest.raises(Exception):
        R.drop_where(d, "no_such_column > 1").collect()

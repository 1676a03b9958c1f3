import gzip
import json
import os

from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.sources import archives as Z
from corpusflow.sources import text_formats as T


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_catalogue(spark, tmp_path):
    item = {"identifier": "x", "files": [{"name": "a.mp3", "size": "10", "format": "MP3"}], "metadata": {"licenseurl": "by", "youtube-id": "7"}}
    with gzip.open(tmp_path / "c.jsonl.gz", "wt") as f:
        f.write(json.dumps(item) + "\n")
    r = T.catalogue(spark, str(tmp_path / "c.jsonl.gz"), 2).select("identifier", F.col("metadata.`youtube-id`").alias("y"), F.col("files")[0]["name"].alias("n")).first()
    assert tuple(r) == ("x", "7", "a.mp3") and len(schemas.METADATA_FIELDS) == 82 and len(schemas.FILE_FIELDS) == 19


def test_ctm(spark):
    good, bad = "u 1 8.0 1.1 word 0.5\nu 1 9.5 0.2 <eps> 1\n", "u 1 8.0 1.1 word 0.5\nbroken line\n"
    d = spark.createDataFrame([(good,), (bad,), ("",)], "c string").select(T.ctm_words(F.col("c")).alias("w")).collect()
    assert [tuple(x) for x in d[0].w] == [("u", "1", 8000, 9100, "word", 0.5)] and d[1].w == [] and d[2].w == []


def test_tables(spark, tmp_path):
    p = put(tmp_path / "segments", "u1 r1 0.5 1.5\n\nu2 r1 2 3\n")
    assert [tuple(r) for r in T.segments(spark, p).orderBy("utt").collect()] == [("u1", "r1", 0.5, 1.5), ("u2", "r1", 2.0, 3.0)]
    p = put(tmp_path / "lexicon", "hello HH AH L\n")
    assert tuple(T.lexicon(spark, p).first()) == ("hello", "HH AH L")
    p = put(tmp_path / "arpa", "\\data\\\nngram 1=1\n\n\\1-grams:\n-1.5\ta\t-0.3\n\n\\2-grams:\n-0.7\ta b\n\\end\\\n")
    assert sorted(tuple(r) for r in T.arpa(spark, p).collect()) == [(1, "a", -1.5, -0.3), (2, "a b", -0.7, 0.0)]
    p = put(tmp_path / "speakers", "; comment\n1 | F | train | 2.5 | A | B\n")
    assert tuple(T.speakers(spark, p).first()) == ("1", "F", "train", 2.5, "A|B")
    p = put(tmp_path / "lines" / "a.txt", "id1 HELLO WORLD\n")
    r = T.transcript_lines(spark, p).first()
    assert r.path.endswith("/lines/id1.flac") and r.label == "HELLO WORLD"
    p = put(tmp_path / "side" / "b.TXT", "0 100 She had your\n")
    assert tuple(T.sidecar_labels(spark, p).first())[:2] == ("b", "She had your")
    p = put(tmp_path / "scores.jsonl", '{"path":"x","seconds":1.5,"Speech":0.9}\n')
    r = T.audio_scores(spark, p).first()
    assert (r.path, r.seconds, r.scores) == ("x", 1.5, {"Speech": 0.9})
    p = put(tmp_path / "device.json", '[{"session_id":"s","speaker_id":"p","words":"hi","start_time":{"d1":"0:00:01.5"},"end_time":{"d1":"0:00:02"}}]')
    rows = T.device_transcripts(spark, p).collect()
    assert len(rows) == 7 and (rows[0].start_ms, rows[0].end_ms) == (1500, 2000)


def test_dataset_csv(spark, tmp_path):
    d = spark.createDataFrame([("a.wav", 'say "hi", you', {"k": "v"}), ("b.wav", "plain", None)], "path string, caption string, fields map<string,string>")
    Z.write_dataset(d, str(tmp_path / "out"))
    rows = {r.path: r for r in T.dataset_csv(spark, str(tmp_path / "out")).collect()}
    assert rows["a.wav"].caption == 'say "hi", you' and rows["a.wav"].fields == {"k": "v"} and rows["b.wav"].fields == {}


def test_tar_round_trip(spark, tmp_path):
    rows = [(f"{'long' * 40}/{i}.bin", bytes([i]) * i) for i in range(20)]
    d = spark.createDataFrame(rows, "key string, value binary").repartition(3)
    for codec in ("", "gz"):
        out = str(tmp_path / f"tar{codec}")
        Z.write_tar(d, out, codec)
        Z.write_tar(d, out, codec)
        assert len([f for f in os.listdir(out) if ".tar" in f]) == 3
        assert sorted((r.key, bytes(r.value)) for r in Z.read_tar(spark, out).collect()) == sorted(rows)
    assert Z.read_tar(spark, out, value=False).columns == ["key"]
    assert sorted((r.key, bytes(r.value)) for r in spark.read.format("tar").load(out).collect()) == sorted(rows)


def test_sample_databases(spark, tmp_path):
    rows = [(bytes([i]) * i, f"said {i} é", float(-i)) for i in range(9)]
    d = spark.createDataFrame(rows, "audio binary, transcript string, duration double")
    Z.write_samples_by_duration(d, str(tmp_path / "sdb"), files=2)
    got = [(bytes(r.audio), r.transcript) for r in spark.read.format("sdb").load(str(tmp_path / "sdb")).collect()]
    assert got == [(a, t) for a, t, _ in reversed(rows)]


def test_warc():
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>x</p>"
    record = lambda kind, body: b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Target-URI: http://a\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    assert list(Z.warc_responses(record(b"request", b"GET /") + record(b"response", http))) == [("http://a", "<p>x</p>")]


def test_listing(spark, tmp_path):
    put(tmp_path / "a.ctm", "x")
    put(tmp_path / "b.txt", "y")
    assert [os.path.basename(r.path) for r in T.files(spark, str(tmp_path), "*.ctm", content=False).collect()] == ["a.ctm"]
    names = spark.createDataFrame([("b.txt",)], "name string")
    assert [bytes(r.content) for r in T.listed_files(spark, str(tmp_path), names).collect()] == [b"y"]

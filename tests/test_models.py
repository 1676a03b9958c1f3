import struct

from corpusflow.operators import models
from corpusflow.sources import records


def varint(n):
    out = b""
    n &= (1 << 64) - 1
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def field(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def feature(name, number, body):
    return field(1, field(1, name.encode()) + field(2, field(number, body)))


def test_examples(spark, tmp_path):
    def record(i):
        body = field(1, feature("id", 1, field(1, f"u{i}é".encode())) + feature("n", 3, field(1, varint(-i) + varint(7))) + feature("x", 2, field(1, struct.pack("<2f", 0.5, i))))
        return struct.pack("<Q", len(body)) + b"crc_" + body + b"crc_"

    (tmp_path / "a.tfrecord").write_bytes(record(1) + record(2))
    got = records.read_examples(spark, str(tmp_path), {"id": "string", "n": "[long]", "x": "[double]", "none": "long"}).collect()
    assert [(r.id, r.n, r.x, r["none"]) for r in got] == [("u1é", [-1, 7], [0.5, 1.0], None), ("u2é", [-2, 7], [0.5, 2.0], None)]


def test_plug_ins(spark):
    def recogniser():
        def run(audio):
            if audio == b"bad":
                raise ValueError
            return f"{len(audio)} bytes"

        return run

    d = spark.createDataFrame([(1, b"abc"), (2, None), (3, b"bad")], "k int, content binary")
    assert {r.k: r.transcript for r in models.transcribed(d, "content", recogniser, ["k"]).collect()} == {1: "3 bytes", 2: None, 3: None}
    t = spark.createDataFrame([("yes",), (None,)], "t string")
    assert [r.x for r in t.select(models.labelled(t, "t", lambda: lambda xs: [x.upper() for x in xs]).alias("x")).collect()] == ["YES", ""]


def test_entities(spark):
    d = spark.createDataFrame([(1, "On March 3, 2020 at 10:30 it cost $5.50, up 12%."), (2, None)], "k int, t string")
    got = {(r.k, r.tag, r.entity) for r in models.entities(d, "k", "t").collect()}
    assert {(1, "DATE", "March 3, 2020"), (1, "MONEY", "$5.50"), (1, "PERCENT", "12%"), (1, "TIME", "10:30")} <= got

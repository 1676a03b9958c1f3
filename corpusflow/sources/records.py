"""TFRecord files of ``Example`` messages, read and written without the library that defines them."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter

from corpusflow.session import ship
from corpusflow.sources.archives import _ArchiveWriter

#: How a column is asked for: the kind of its values, one or many.
KINDS = {"bytes": pa.binary(), "string": pa.string(), "long": pa.int64(), "double": pa.float64()}


def records(data: bytes) -> Iterator[bytes]:
    """Messages of a file: length, its checksum, message, its checksum."""
    at = 0
    while at + 12 <= len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        yield data[at + 12 : at + 12 + size]
        at += size + 16


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def message(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(field number, wire type, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield key >> 3, kind, value


def example(data: bytes) -> dict[str, list]:
    """Feature lists by name: bytes, floats or signed 64-bit integers."""
    out: dict[str, list] = {}
    for _, _, features in message(data):
        for _, _, entry in message(features):
            cell = {n: v for n, _, v in message(entry)}
            values: list = []
            for number, _, body in message(cell.get(2, b"")):
                for _, kind, v in message(body):
                    if number == 1:
                        values.append(v)
                    elif number == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    elif kind == 0:
                        values.append(_signed(v))
                    else:
                        at = 0
                        while at < len(v):
                            x, at = _varint(v, at)
                            values.append(_signed(x))
            out[cell.get(1, b"").decode()] = values
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _crc_table() -> list[int]:
    """CRC-32C, the low bit first."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        out.append(n)
    return out


CRC = _crc_table()


def masked_crc(data: bytes) -> int:
    """The checksum of a record's length or message: CRC-32C, turned by 15 bits, plus a constant (fixed by the format)."""
    c = 0xFFFFFFFF
    for b in data:
        c = CRC[(c ^ b) & 0xFF] ^ c >> 8
    c ^= 0xFFFFFFFF
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def _coded(number: int) -> bytes:
    number &= (1 << 64) - 1
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    return bytes([*out, number])


def _part(field: int, body: bytes) -> bytes:
    return _coded(field << 3 | 2) + _coded(len(body)) + body


def put_example(values: Mapping[str, object]) -> bytes:
    """An ``Example`` of bytes, texts, whole numbers and floats, one or a list of each; nulls are left out."""
    entries = []
    for name, value in values.items():
        if value is None:
            continue
        many = value if isinstance(value, list) else [value]
        if many and isinstance(many[0], float):
            feature = _part(2, _part(1, struct.pack(f"<{len(many)}f", *many)))
        elif many and isinstance(many[0], int):
            feature = _part(3, _part(1, b"".join(map(_coded, many))))
        else:
            feature = _part(1, b"".join(_part(1, v.encode() if isinstance(v, str) else bytes(v)) for v in many))
        entries.append(_part(1, _part(1, name.encode()) + _part(2, feature)))
    return _part(1, b"".join(entries))


class _RecordWriter(_ArchiveWriter):
    end = ".tfrecord"

    def put(self, path: str, rows) -> None:
        with open(path, "wb") as out:
            for row in rows:
                body = put_example(row.asDict())
                size = struct.pack("<Q", len(body))
                out.write(size + struct.pack("<I", masked_crc(size)) + body + struct.pack("<I", masked_crc(body)))


class RecordSink(DataSource):
    """``format("tfrecord")``, to write: a row an example.  For paths on a shared mount."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return "key string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _RecordWriter(self.options["path"], overwrite, self.options)


def write_examples(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """One file a partition of the chosen columns."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(RecordSink)
    (df.select(*columns) if columns else df).write.format("tfrecord").mode("overwrite").save(path)


def read_examples(spark: SparkSession, path: str, columns: Mapping[str, str], glob: str = "*.tfrecord*") -> DataFrame:
    """One row an example; ``columns`` gives each name one of ``KINDS``, in brackets for a list (``[long]``)."""
    ship(spark)
    kinds = {n: (k.strip("[]"), k.startswith("[")) for n, k in columns.items()}
    sql = {"bytes": "binary", "string": "string", "long": "bigint", "double": "double"}
    schema = ", ".join(f"`{n}` {f'array<{sql[k]}>' if many else sql[k]}" for n, (k, many) in kinds.items())

    def cell(values: list, kind: str, many: bool):
        values = [v.decode("utf-8", "replace") for v in values] if kind == "string" else values
        return values if many else values[0] if values else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [example(r) for r in records(content.as_py())]
                cols = [pa.array([cell(r.get(n, []), k, many) for r in rows], pa.list_(KINDS[k]) if many else KINDS[k]) for n, (k, many) in kinds.items()]
                yield pa.RecordBatch.from_arrays(cols, names=list(kinds))

    content = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("content")
    return content.mapInArrow(run, schema)

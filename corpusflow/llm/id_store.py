"""Token ids on disk: one zstandard frame a document, a dictionary for all of them, and an index of offsets.

A store is a folder.  ``dictionary.zst`` holds the dictionary, trained on the serialized ids of a bounded sample of short
documents.  ``shards/part-...`` hold the documents in ascending order of their ids, a range of them each:

    frames         zstandard frames without checksum or dictionary number, of little-endian unsigned 32-bit ids;
                   a line feed after each run of about RUN_BYTES (Spark's writer ends a record so)
    index          a frame: doc_id (int64), offset (int64), size of the frame (int64), number of ids (int64), as
                   four columns; and a byte a document that says whether its doc_id is null
    trailer        TRAILER bytes: MAGIC, sha256 of the dictionary, documents, offset and size of the index; a line feed

``IdStore.ids`` finds one document by the trailers, one index and one frame: nothing else is read.  Shards are written
and read through Spark, and single documents through Hadoop's file system, so that any folder it knows will do; a task
that is run again replaces its file as a whole.

Defined results: a null or empty text is the end id alone; documents are encoded whole; repeated doc_ids lie side by
side, by the hash of their texts and the texts themselves; null doc_ids come first; an empty table gives a store without
documents; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches, slices
from corpusflow.llm.scratch import Scratch
from corpusflow.llm.tokens import byte_unit_ids

END_ID = 2
MAGIC = b"CFIDS001"
TRAILER = len(MAGIC) + 32 + 3 * 8
#: Documents of the sample that the dictionary is trained on, and the longest text among them in bytes.
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 4096
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
RUN_BYTES = 1 << 20
#: Bytes of text of a shard, on average.
SHARD_BYTES = 64 << 20


def serialized(tokenizer: str, raw: list, end_id: int = END_ID) -> list[bytes]:
    end = end_id.to_bytes(4, "little")
    return [ids + end for ids in byte_unit_ids(tokenizer).encode(raw)]


def train_dictionary(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES; empty if there is too little to learn from."""
    short = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    share = F.lit(min(1.0, 2 * SAMPLE_DOCS / max(1, short.count())))  # some twice as many as are asked for
    few = short.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share * F.lit(1 << 30))
    sample = few.orderBy(F.xxhash64("id", "text"), "id", "text").limit(SAMPLE_DOCS).collect()
    samples = serialized(tokenizer, [r.text.encode() for r in sample], end_id)
    if len(samples) < 10:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too short
        return b""


class Codec:
    def __init__(self, dictionary: bytes) -> None:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        plain = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_checksum=0, write_dict_id=0, write_content_size=1)
        self.pack = zstandard.ZstdCompressor(dict_data=known, compression_params=plain).compress
        self.unpack = zstandard.ZstdDecompressor(dict_data=known).decompress


def shard(texts: Iterator[tuple[list, list]], tokenizer: str, dictionary: bytes, end_id: int = END_ID) -> Iterator[bytes]:
    """The records of one shard from (doc_ids, texts), each to be followed by a line feed; none without documents."""
    codec, rows, run, held, at = Codec(dictionary), [], [], 0, 0
    for keys, raw in texts:
        for k, ids in zip(keys, serialized(tokenizer, raw, end_id), strict=True):
            frame = codec.pack(ids)
            rows.append((k, at + held, len(frame), len(ids) // 4))
            run.append(frame)
            held += len(frame)
            if held >= RUN_BYTES:
                yield b"".join(run)
                at, run, held = at + held + 1, [], 0
    if not rows:
        return
    if run:
        yield b"".join(run)
        at += held + 1
    columns = [np.array([r[i] or 0 for r in rows], "<i8").tobytes() for i in range(4)]
    index = codec.pack(b"".join(columns) + bytes(r[0] is None for r in rows))
    yield index + MAGIC + hashlib.sha256(dictionary).digest() + struct.pack("<3q", len(rows), at, len(index))


def read_trailer(raw: bytes, dictionary: bytes) -> tuple[int, int, int]:
    """(documents, offset and size of the index); an error if the shard is of another format or dictionary."""
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of ids")
    if raw[len(MAGIC) : len(MAGIC) + 32] != hashlib.sha256(dictionary).digest():
        raise ValueError("the shard was written with another dictionary")
    return struct.unpack("<3q", raw[len(MAGIC) + 32 : TRAILER])


def read_index(raw: bytes, codec: Codec, n: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, offsets, sizes, numbers of ids)."""
    plain = codec.unpack(raw)
    keys, offset, size, count = np.frombuffer(plain, "<i8", 4 * n).reshape(4, n)
    null = np.frombuffer(plain, np.uint8, offset=32 * n).astype(bool)
    return [None if gone else int(k) for k, gone in zip(keys, null, strict=True)], offset, size, count


class IdStore:
    """A store in ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _bytes(self, path: str, start: int, size: int) -> bytes:
        place, system = self._place(path)
        stream = system.open(place)
        try:
            stream.seek(start)
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)) if size else b""
        finally:
            stream.close()

    def dictionary(self) -> bytes:
        place, system = self._place(f"{self.path}/dictionary.zst")
        return self._bytes(f"{self.path}/dictionary.zst", 0, system.getFileStatus(place).getLen())

    def write(self, docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
        """All documents, in ascending order of ``key``."""
        bounded_batches(self.spark)
        dictionary = train_dictionary(docs, tokenizer, key, text, end_id)
        place, system = self._place(f"{self.path}/dictionary.zst")
        out = system.create(place)
        out.write(dictionary)
        out.close()
        rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
        order = [F.col("id"), F.xxhash64("text"), F.col("text")]
        rows = rows.repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = ((b.column(0).slice(start, len(raw)).to_pylist(), raw) for b in batches for start, raw in slices(b.column(1)))
            for record in shard(texts, tokenizer, dictionary, end_id):
                yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["value"])

        # the text writer writes a string's bytes as they are, and a line feed
        rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 0).option("compression", "none").text(f"{self.path}/shards")

    def documents(self) -> DataFrame:
        """shard, doc_id, before (ids of the shard's earlier documents), n_tokens, ids_crc32: read from the shards."""
        bounded_batches(self.spark)
        dictionary = self.dictionary()
        kind = [("shard", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = Codec(dictionary)
            for batch in batches:
                for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = memoryview(content.as_buffer())
                    n, at, size = read_trailer(bytes(raw[-TRAILER - 1 : -1]), dictionary)
                    keys, offset, sizes, count = read_index(bytes(raw[at : at + size]), codec, n)
                    number, before = shard_number(path), np.cumsum(count) - count
                    for s in range(0, n, 4096):
                        part = range(s, min(n, s + 4096))
                        crc = [zlib.crc32(codec.unpack(raw[offset[i] : offset[i] + sizes[i]])) for i in part]
                        columns = [[number] * len(part), keys[s : s + 4096], before[s : s + 4096], count[s : s + 4096], crc]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kind, strict=True)], names=[c for c, _ in kind])

        files = self.spark.read.format("binaryFile").load(f"{self.path}/shards").filter("length > 0").select("path", "content")
        return files.mapInArrow(run, "shard int, doc_id long, before long, n_tokens long, ids_crc32 long")

    def ids(self, doc_id: int) -> list[list[int]]:
        """The ids of each document with ``doc_id``, by offsets: of a shard only the trailer, the index and these frames are read."""
        dictionary, found = self.dictionary(), []
        codec = Codec(dictionary)
        place, system = self._place(f"{self.path}/shards")
        files = sorted((shard_number(f.getPath().toString()), f.getPath().toString(), f.getLen()) for f in system.listStatus(place) if f.getLen() and f.getPath().getName().startswith("part-"))
        indexes: dict[int, tuple] = {}

        def index(k: int) -> tuple:
            if k not in indexes:
                _, path, size = files[k]
                n, at, held = read_trailer(self._bytes(path, size - TRAILER - 1, TRAILER), dictionary)
                indexes[k] = read_index(self._bytes(path, at, held), codec, n)
            return indexes[k]

        low, high = 0, len(files)
        while low < high:  # shards hold ascending ranges: the first whose last document isn't smaller
            middle = (low + high) // 2
            last = index(middle)[0][-1]
            low, high = (middle + 1, high) if last is None or last < doc_id else (low, middle)
        for k in range(low, len(files)):
            keys, offset, size, _ = index(k)
            for i, key in enumerate(keys):
                if key == doc_id:
                    found.append(np.frombuffer(codec.unpack(self._bytes(files[k][1], int(offset[i]), int(size[i]))), "<u4").tolist())
            if keys[-1] is not None and keys[-1] > doc_id:
                break
        return found


def shard_number(path: str) -> int:
    return int(re.search(r"part-(\d+)", path.rsplit("/", 1)[-1])[1])


def with_starts(read: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: ids of earlier shards (a number for each) added to those before a document in its own."""
    read = scratch.table(read)
    ahead, starts = 0, []
    for r in read.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect():  # a row for each shard
        starts.append((r.shard, ahead))
        ahead += r.n
    offsets = F.broadcast(read.sparkSession.createDataFrame(starts, "shard int, ahead long"))
    return read.join(offsets, "shard").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op11_id_store(spark, sf_dir: str) -> DataFrame:
    """All documents, written in ascending doc_id order and read again."""
    import public_tokenizers

    scratch = Scratch(spark)
    store = IdStore(spark, f"{scratch.root}/store")
    store.write(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return with_starts(store.documents(), scratch)

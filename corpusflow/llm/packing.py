"""Packing: best-fit decreasing into fixed windows.

Documents are encoded where they lie; one longer than a window is first cut into full windows, which
are sequences of their own, and a rest.  Pieces are dealt by hash into buckets of a bounded expected number of pieces; in each
bucket, longest first, a segment tree indexed by remaining capacity finds the tightest open window.  Equal pieces (of
repeated rows) are first counted and numbered, and the number is hashed, too, so that no id however frequent gathers in one
bucket.  What is hashed is the piece alone: documents lie in the same places whatever their partitions were, and a task that
is run again deals the same.  Padding is what the last windows of each bucket lack, well under one per cent.

Defined results: a null or empty text is the end id alone; repeated rows are packed as often as they
occur; ties in length go by (doc_id, start, ids_crc32); texts are encoded whole; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches, slices
from corpusflow.llm.scratch import Scratch
from corpusflow.llm.tokens import word_ids

WINDOW = 2048
END_ID = 1
#: Pieces a bucket, on average.
BUCKET_PIECES = 16384
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Open windows by remaining capacity; leaf c counts those with c left, inner nodes add up."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def add(self, capacity: int, which: int) -> None:
        self.open.setdefault(capacity, []).append(which)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window with at least ``need`` left, removed."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.size
        which = self.open[capacity].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, which


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window, offset) of each length, placed in the order given; callers sort longest first."""
    tree, used = CapacityTree(window), 0
    where, offset = [], []
    for n in lengths:
        found = tree.take(n)
        if found is None:
            found, used = (window, used), used + 1
        left, which = found
        where.append(which)
        offset.append(window - left)
        if left > n:
            tree.add(left - n, which)
    return where, offset


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Full windows and one rest of each document, with the crc32 of their ids."""
    bounded_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, raw in slices(batch.column(1)):
                rows = []
                for k, ids in zip(keys[first:], encoder.encode(raw), strict=False):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append((k, start, len(part) // 4, zlib.crc32(part), total))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, PIECES)


def pack(cut: DataFrame, window: int = WINDOW, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; the bucket is the id's upper half, so ids never clash."""
    cut = Scratch(cut.sparkSession).table(cut)
    buckets = max(1, -(-cut.count() // bucket_pieces))
    names = cut.columns
    copies = cut.groupBy(*names).agg(F.count("*").alias("copies")).select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    dealt = copies.select(*names, F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32", "copy"), F.lit(buckets)).alias("bucket"))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        base = group.column("bucket")[0].as_py() << 32
        where, offset = best_fit(group.column("length").to_pylist(), window)
        out = group.drop_columns(["bucket"])
        return out.append_column("sequence_id", pa.array([base + w for w in where], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("bucket").applyInArrow(fill, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(pieces(docs, tokenizer))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 ids."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Media columns: texts kept in progressive JPEGs, and JPEGs as full-resolution RGB tensors.

A JPEG's lossless unit is the quantised coefficient, so a payload byte b is the coefficient b - 128.  The two
chroma components have half the luma's resolution both ways, so an MCU of 16 by 16 pixels has six blocks, that is 384
bytes; a file's bytes go through its luma blocks, then through those of either chroma component.  Images are strips of
16 pixels by as many MCUs as there are, up to 4095, then of more columns.  The payload's length is in a comment.  Tensors
are RGB at full resolution: coefficients are transformed back and chroma is upsampled.

Defined results: null and empty texts are 192 spaces; texts are stored whole; equal texts give equal files and features;
repeated rows give repeated rows; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import jpeg
from corpusflow.llm.arrow import scored, with_kernel

UNIT = 192
#: Bytes of an MCU.
MCU = 384
TALLEST = 4095
#: Bytes of text that are coded together: working arrays take some 80 bytes for each.
TOGETHER = 1 << 20
PARTS = (jpeg.Component(1, 2, 2, 0), jpeg.Component(2, 1, 1, 0), jpeg.Component(3, 1, 1, 0))
FIELDS = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]


def payload(text: bytes | None) -> bytes:
    text = text or b""
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b" ")


def strip(units: int) -> jpeg.Frame:
    columns = -(-units // TALLEST)
    return jpeg.frame_of(16 * columns, 16 * -(-units // columns), PARTS)


def write(payloads: list[bytes]) -> list[bytes]:
    """One JPEG for each payload."""
    frames, rows = [], []
    for p in payloads:
        f = strip(-(-len(p) // MCU))
        frames.append(f)
        rows.append(np.frombuffer(p.ljust(f.mcus[0] * f.mcus[1] * MCU, b"\x80"), np.uint8).reshape(-1, 64))
    coef = np.concatenate(rows).astype(np.int16) - 128
    return jpeg.encode(frames, coef, [b"payload %d" % len(p) for p in payloads])


def read(files: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """(payload, RGB tensor) of each JPEG."""
    images = [jpeg.parse(x) for x in files]
    coef, base = jpeg.coefficients(images)
    stored = (coef + 128).astype(np.uint8)
    pixels = jpeg.samples(coef, images[0].quant[0]) if images else None
    out = []
    for n, i in enumerate(images):
        a, b = int(base[n]), int(base[n + 1])
        out.append((stored[a:b].tobytes()[: int(i.comment.split()[1])], jpeg.assembled(i.frame, pixels[a:b])))
    return out


def feature(tensor: np.ndarray) -> str:
    """Size, mean colours and a digest of an RGB tensor."""
    mean = tensor.reshape(-1, 3).sum(axis=0, dtype=np.int64) * 100 // (tensor.shape[0] * tensor.shape[1])
    return f"{tensor.shape[1]}x{tensor.shape[0]};{','.join(map(str, mean.tolist()))};{zlib.crc32(np.ascontiguousarray(tensor)):08x}"


def stored_texts(raw: list) -> list[list]:
    files = write([payload(b) for b in raw])
    rows = []
    for b, f, (p, tensor) in zip(raw, files, read(files), strict=True):
        rows.append((len(b or b""), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(f), hashlib.sha256(f).hexdigest(), feature(tensor)))
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in FIELDS]


def with_tensors(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """``key``, height, width and ``rgb`` (row-major bytes) of progressive JPEGs; nulls where a file can't be read."""

    def kernel(raw: list) -> list[list]:
        rows = []
        for b in raw:
            try:
                t = jpeg.decode(b) if b else None
            except (ValueError, IndexError, KeyError, AttributeError, struct.error):
                t = None
            rows.append((None, None, None) if t is None else (t.shape[0], t.shape[1], t.tobytes()))
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]

    slim = df.select(key, F.col(media).cast("binary").alias("__media"))
    return with_kernel(slim, kernel, [("height", T.IntegerType()), ("width", T.IntegerType()), ("rgb", T.BinaryType())], "__media").drop("__media")


def as_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``media``: the text's payload as a JPEG."""
    return scored(docs, lambda raw: [write([payload(b) for b in raw])], [("media", T.BinaryType())], (key,), text, TOGETHER)


def op8_media_columns(spark, sf_dir: str) -> DataFrame:
    """Every document written as a JPEG, read back, and digested."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), stored_texts, FIELDS, limit=TOGETHER)

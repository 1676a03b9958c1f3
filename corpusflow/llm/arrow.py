"""Shared plumbing of the Arrow-backed operators.

Kernels get a list of ``bytes | None`` (UTF-8 texts) and return one sequence per output
field.  They are applied to slices of bounded size, so that a Python worker holds a few
megabytes of text at a time whatever the length of the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.session import ship

#: Bytes of text that a kernel gets at once (a longer single text still comes whole).
SLICE_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: documents may be 100 kB each; and let the workers import this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list]]:
    """(start, texts as bytes) for runs of rows of at most ``limit`` bytes, or of one row."""
    raw = texts.cast(pa.binary()).to_pylist()
    start, size = 0, 0
    for i, b in enumerate(raw):
        n = len(b) if b is not None else 0
        if i > start and size + n > limit:
            yield start, raw[start:i]
            start, size = i, 0
        size += n
    if start < len(raw):
        yield start, raw[start:]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while the frame has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_kernel(df: DataFrame, kernel: Callable[[list], Sequence], fields: Sequence[tuple[str, T.DataType]], text_col: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """All columns of ``df`` and, after them, what ``kernel`` makes of the texts (one row in, one out).

    The new columns take the names of ``fields``; the caller picks names that are free (``fresh``).
    """
    bounded_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])
    at, types = df.columns.index(text_col), [to_arrow_type(t) for _, t in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw in slices(batch.column(at), limit):
                part = batch.slice(start, len(raw))
                made = [pa.array(x, type=t) for x, t in zip(kernel(raw), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)

    return df.mapInArrow(run, schema)


def scored(df: DataFrame, kernel: Callable[[list], Sequence], fields: Sequence[tuple[str, T.DataType]], keep: Sequence[str] = ("doc_id",), text_col: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Only ``keep`` and the kernel's columns; of the input, nothing but ``keep`` and the text is read."""
    slim = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    return with_kernel(slim, kernel, fields, "__text", limit).drop("__text")


def crc_bucket(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids: those of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)

"""Token counts: offset-mapped attribution.

A text is encoded once and whole.  The byte spans of its tokens are interval-joined with the spans of
its sections (or of the fields that it was put together from); a token inside one span counts there,
and one that crosses a boundary is allotted by an explicit rule:

* ``majority``: to the span that holds most of its bytes, the first such on a tie;
* ``first`` / ``last``: to the span of its first / last byte.

So counts add up to those of the whole text.  Defined results: a null or empty text has one empty
section without tokens; repeated rows give repeated sections; an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches, fresh, slices
from corpusflow.llm.tokens import rank_tokenizer

RULES = ("majority", "first", "last")


def attribute(token_ends: np.ndarray, span_ends: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, boundary-crossing tokens allotted) of each span; both arrays hold running ends from 0.

    Spans follow each other without a gap and may be empty; an empty span gets no token.
    """
    n = len(span_ends)
    starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    first = np.searchsorted(span_ends, starts, side="right")
    last = np.searchsorted(span_ends, token_ends - 1, side="right")
    owner = (last if rule == "last" else first).copy()
    crossing = np.flatnonzero(first != last)
    if rule == "majority":
        for i in crossing:
            best, most = first[i], 0
            for s in range(first[i], last[i] + 1):
                held = min(span_ends[s], token_ends[i]) - max(span_ends[s - 1] if s else 0, starts[i])
                if held > most:
                    best, most = s, held
            owner[i] = best
    return np.bincount(owner, minlength=n)[:n], np.bincount(owner[crossing], minlength=n)[:n]


def token_ends(text: bytes, encoder) -> np.ndarray:
    encoding, sizes = encoder
    return np.cumsum(sizes[np.array(encoding.encode_ordinary(text.decode()), np.int64)])


def sections(text: bytes, separator: bytes = b"\n") -> np.ndarray:
    """Running byte ends of the sections; a separator belongs to the section before it."""
    at = np.flatnonzero(np.frombuffer(text, np.uint8) == separator[0]) + 1
    return at if len(at) and at[-1] == len(text) else np.append(at, len(text))


def by_section(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "majority", key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each line of each text: its character span, tokens, and crossing tokens among them."""
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    bounded_batches(docs.sparkSession)
    schema = f"{key} long, section long, char_start long, char_end long, n_tokens long, n_crossing long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_tokenizer(vocabulary, pattern)
        for batch in batches:
            keys = batch.column(0)
            for first, raw in slices(batch.column(1)):
                cols: list[list] = [[], [], [], [], [], []]
                for i, b in enumerate(raw):
                    b = b or b""
                    ends = sections(b)
                    tokens, crossing = attribute(token_ends(b, encoder), ends, rule)
                    chars = ends if b.isascii() else np.concatenate(([0], np.cumsum((np.frombuffer(b, np.uint8) & 0xC0) != 0x80)))[ends]
                    for c, x in zip(cols, (np.full(len(ends), first + i), np.arange(len(ends)), np.concatenate(([0], chars[:-1])), chars, tokens, crossing), strict=True):
                        c.append(x)
                flat = [np.concatenate(c).astype(np.int64) for c in cols]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(flat[0])), *map(pa.array, flat[1:])], names=[key, "section", "char_start", "char_end", "n_tokens", "n_crossing"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def by_field(df: DataFrame, fields: Sequence[str], vocabulary: str, pattern: str, rule: str = "majority", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` and a column ``n_tokens`` (field -> tokens), the fields' texts put together and encoded once."""
    bounded_batches(df.sparkSession)
    whole = F.concat(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    ends, total = [], F.lit(0).cast("long")
    for f in fields:
        total = total + F.coalesce(F.octet_length(F.col(f).cast("string")), F.lit(0))
        ends.append(total)
    slim = df.select(*keys, whole.alias(fresh(df, "__text")), F.array(*ends).alias(fresh(df, "__ends")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keys).schema) + ", tokens array<bigint>"
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_tokenizer(vocabulary, pattern)
        for batch in batches:
            raw = batch.column(n).cast(pa.binary()).to_pylist()
            made = [attribute(token_ends(b, encoder), np.array(e), rule)[0] for b, e in zip(raw, batch.column(n + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(made, pa.list_(pa.int64()))], names=[*batch.schema.names[:n], "tokens"])

    made = slim.mapInArrow(run, schema)
    return made.select(*keys, F.map_from_arrays(F.array(*map(F.lit, fields)), F.col("tokens")).alias("n_tokens"))


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, boundary-crossing ones by majority."""
    import public_tokenizers as P

    return by_section(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)

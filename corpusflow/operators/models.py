"""Models as plug-ins: recognisers, taggers and classifiers applied in Arrow batches.

A factory that a module defines is called once a Python worker; one made on the spot, once a task."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import ship


@lru_cache(4)
def _loaded(factory: Callable[[], Callable]) -> Callable:
    return factory()


def transcribed(df: DataFrame, content: str, factory: Callable[[], Callable[[bytes], str]], keep: Sequence[str], name: str = "transcript") -> DataFrame:
    """``keep`` and a transcript of each recording; ``factory`` makes a function of bytes.

    A recording that the model fails on has a null transcript; batches go through one row at a time, as a row can be long.
    """
    ship(df.sparkSession)
    slim = df.select(*keep, content)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.drop(content).schema) + f", `{name}` string"
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(factory)
        for batch in batches:
            out = []
            for x in batch.column(n):
                try:
                    out.append(None if x.as_py() is None else model(x.as_py()))
                except (ValueError, RuntimeError):
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.string())], names=[*batch.schema.names[:n], name])

    return slim.mapInArrow(run, schema)


def labelled(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], list[str | None]]], on_error: str = "problem") -> Column:
    """A label of each text by a model of text lists; where it fails, ``on_error``."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        values = [t or "" for t in texts.to_pylist()]
        try:
            return pa.array(_loaded(factory)(values), pa.string())
        except (ValueError, RuntimeError):
            return pa.array([on_error] * len(values), pa.string())

    return run(F.col(text))


# Kinds of entities that patterns can tell.
PATTERNS = {
    "CARDINAL": r"\b\d+(?:[.,]\d+)*\b(?!\s*%)",
    "DATE": r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December)(?:\s+\d{1,2})?(?:,?\s+\d{4})?\b",
    "MONEY": r"[$€£]\s?\d+(?:[.,]\d+)*",
    "PERCENT": r"\b\d+(?:\.\d+)?\s*%",
    "TIME": r"\b\d{1,2}:\d{2}(?::\d{2})?\b",
}


def entities(df: DataFrame, key: str, text: str, patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """(key, tag, entity) of what the patterns find, in long form: the built-in stand-in for a tagger."""
    for p in patterns.values():
        re.compile(p)
    found = F.array(*[F.struct(F.lit(tag).alias("tag"), F.regexp_extract_all(F.col(text), F.lit(f"({p})"), F.lit(1)).alias("found")) for tag, p in sorted(patterns.items())])
    return df.select(key, F.inline(found)).select(key, "tag", F.explode("found").alias("entity"))

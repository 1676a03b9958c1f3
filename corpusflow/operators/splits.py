"""Debiasing, partitions by quality, and splits that keep entities and hold-outs apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import kernels
from corpusflow.operators.relational import digest_order, numbered


def debiased(df: DataFrame, by: str, quality: str, key: str, sigma: float = 3.0) -> DataFrame:
    """At most int(mean + sigma * population deviation) of the group sizes from each value, best quality first.

    Rows without a value stay; of equal quality the larger key stays.
    """
    known = df.filter(F.col(by).isNotNull())
    sizes = known.groupBy(by).agg(F.count("*").alias("n"))
    cap = sizes.agg(F.floor(F.avg("n") + sigma * F.stddev_pop("n")).alias("cap"))
    rn = F.row_number().over(W.partitionBy(by).orderBy(F.desc(quality), F.desc(key)))
    kept = known.withColumn("__rn", rn).crossJoin(F.broadcast(cap)).filter(F.col("__rn") <= F.col("cap")).drop("__rn", "cap")
    return kept.unionByName(df.filter(F.col(by).isNull()))


def quality_part(quality: Column, parts: Sequence[tuple[float, str]], other: str) -> Column:
    """The first part, from the highest bound down, whose bound the quality reaches."""
    out = None
    for bound, name in sorted(parts, reverse=True):
        out = F.when(quality >= bound, F.lit(name)) if out is None else out.when(quality >= bound, F.lit(name))
    return out.otherwise(F.lit(other))


def random_split(df: DataFrame, key: str, test: int, dev: int, seed: str = "42") -> DataFrame:
    """``split``: the first ``test`` rows of a fixed shuffle, the next ``dev``, the rest for training."""
    placed = numbered(df.withColumn("__digest", digest_order(F.col(key), seed=seed)), ["__digest", key], "__place")
    split = F.when(F.col("__place") < test, "test").when(F.col("__place") < test + dev, "dev").otherwise("train")
    return placed.withColumn("split", split).drop("__digest", "__place")


def entity_split(df: DataFrame, entity: str, test: int, dev: int, assigned: DataFrame | None = None) -> DataFrame:
    """``split`` in which no entity is in two: entities, smallest first, fill test up to its rows, then dev; the rest train.

    Entities of ``assigned`` (entity, split) go where it says, and their rows count as filled.
    """
    if assigned is not None:
        own = df.join(assigned, entity)
        held = {r["split"]: r["count"] for r in own.groupBy("split").count().collect()}  # a row a split
        rest = entity_split(df.join(assigned, entity, "left_anti"), entity, max(0, test - held.get("test", 0)), max(0, dev - held.get("dev", 0)))
        return rest.unionByName(own.select(*rest.columns))
    sizes = df.groupBy(entity).agg(F.count("*").alias("n"))
    upto = F.col("before") + F.col("n")
    split = F.when(upto <= test, "test").when(upto <= test + dev, "dev").otherwise("train")
    return df.join(numbered(sizes, ["n", entity], "place", "before", "n").select(entity, split.alias("split")), entity)


def speaker_split(df: DataFrame, speaker: str, test_speakers: int, seed: str = "42") -> DataFrame:
    """``split``: all rows of so many speakers (but not of all) are for testing."""
    who = df.select(speaker).distinct().withColumn("digest", digest_order(F.col(speaker), seed=seed))
    few = min(test_speakers, who.count() - 1)
    return df.join(numbered(who, ["digest", speaker]).select(speaker, F.when(F.col("place") < few, "test").otherwise("train").alias("split")), speaker)


def released_split(both: DataFrame, test: DataFrame, train: DataFrame, key: str, test_rows: int, dev_rows: int, seed: str = "42") -> DataFrame:
    """Test and dev from ``both`` and ``test`` in a fixed shuffle; what of ``both`` is in neither, and ``train``, for training."""
    pool = random_split(both.unionByName(test).dropDuplicates([key]), key, test_rows, dev_rows, seed)
    held = pool.filter("split <> 'train'")
    rest = both.dropDuplicates([key]).unionByName(train).join(held, key, "left_anti").dropDuplicates([key])
    return held.unionByName(rest.withColumn("split", F.lit("train")))


def balanced_split(df: DataFrame, speaker: str, parts: int, most_speakers: int = 1_000_000) -> DataFrame:
    """``part`` from 0: speakers in order, dealt out evenly and then moved over at the edges while that evens out two neighbours.

    The moves go over a number a speaker, in order, on the driver: more than ``most_speakers`` of these are an error.
    """
    sizes = df.groupBy(speaker).agg(F.count("*").alias("n"))
    if sizes.count() > most_speakers:
        raise ValueError(f"more than {most_speakers} speakers")
    rows = sizes.orderBy(speaker).collect()
    dealt = kernels.balanced([r.n for r in rows], parts)
    table = df.sparkSession.createDataFrame([(r[speaker], p) for r, p in zip(rows, dealt, strict=True)], f"{speaker} {dict(df.dtypes)[speaker]}, part int")
    return df.join(table, speaker)

"""Reverberated and noisy copies of recordings: which room, which noises, where and how loud; all of it a function of the copy's name."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.operators.relational import digest_order, numbered
from corpusflow.session import written

#: Probabilities are added up as decimals, so that a sum does not depend on how the rows lie.
EXACT = "decimal(27,26)"


def chance(*key: Column, seed: str) -> Column:
    """A number from 0 to 1 (exclusive) from the md5 of seed and key."""
    return F.conv(F.substring(digest_order(*key, seed=seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def smoothed(items: DataFrame, weight: float = 0.0, probability: str = "probability") -> DataFrame:
    """``items`` with probabilities that sum to one: those that have none share what the others leave, and the others are drawn
    towards such a share by ``weight``.  Where the others leave nothing, those without one get none."""
    p = F.col(probability)
    added = lambda c: F.sum(c.cast("decimal(38,26)")).cast("double")
    total = items.agg(F.count_if(p.isNull()).alias("__none"), F.coalesce(added(p), F.lit(0.0)).alias("__given"))  # one row
    even = F.when((F.col("__none") > 0) & (F.col("__given") < 1), (1 - F.col("__given")) / F.col("__none")).otherwise(0.0)
    d = items.crossJoin(F.broadcast(total)).withColumn("__p", F.coalesce((1 - weight) * p + weight * even, even))
    whole = d.agg(added(F.col("__p")).alias("__sum"))  # one row
    return d.crossJoin(F.broadcast(whole)).withColumn(probability, F.col("__p") / F.col("__sum")).select(*items.columns)


def _parts(n: Column) -> Column:
    """A power of two that is no less than ``n``: as many equal parts of the line from 0 to 1."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double")))).cast("int")


def _part(u: Column) -> Column:
    return F.least(F.floor(u * F.col("__parts")), F.col("__parts") - 1).cast("int")


def _looked_up(df: DataFrame, u: str, line: DataFrame, of: Sequence[str] = ()) -> DataFrame:
    """``df`` with the row of ``line`` (__from, __to, ``of``) that ``u`` falls in.

    Both sides meet by equal parts of the line, as many as it has rows: a part has one row or two on average, weighed by how often it is asked for.
    """
    size = line.groupBy(*of).agg(_parts(F.count("*")).alias("__parts"))  # a row for each line
    sized = lambda d: d.join(size, list(of)) if of else d.crossJoin(F.broadcast(size))
    rows = sized(line).withColumn("__part", F.explode(F.sequence(_part(F.col("__from")), _part(F.col("__to"))))).drop("__parts")
    asked = sized(df).withColumn("__part", _part(F.col(u))).drop("__parts")
    return asked.join(rows, [*of, "__part"]).filter((F.col(u) >= F.col("__from")) & (F.col(u) < F.col("__to"))).drop("__part", "__from", "__to")


def picked(df: DataFrame, u: str, items: DataFrame, order: str, probability: str = "probability") -> DataFrame:
    """``df`` with the columns of one of ``items`` (each with its probability), by where ``u`` falls among their cumulated probabilities.

    The list of items may be as long as it likes: it is added up by ranges of ``order``.
    """
    line = numbered(items.filter(F.col(probability) > 0).withColumn("__p", F.col(probability).cast(EXACT)), [order], "__place", "__before", "__p")
    line = line.crossJoin(F.broadcast(line.agg(F.max("__place").alias("__last"))))  # one row
    upto = (F.col("__before").cast("decimal(37,26)") + F.col("__p")).cast("double")  # the next row's __from, to the last bit
    line = line.select(*[c for c in items.columns if c != probability], F.col("__before").cast("double").alias("__from"), F.when(F.col("__place") == F.col("__last"), 2.0).otherwise(upto).alias("__to"))
    return _looked_up(df, u, line)


def cyclic(df: DataFrame, order: Sequence[str], values: Sequence[float], name: str = "value", seed: str = "cycle") -> DataFrame:
    """Row i in order takes value i mod their number, of ``values`` in a seeded order; so all are taken equally often."""
    told = sorted(values, key=lambda v: hashlib.md5(f"{seed}/{v}".encode()).hexdigest())
    return numbered(df, order, "__place").withColumn(name, F.get(F.array(*map(F.lit, told)), F.pmod("__place", F.lit(len(told))).cast("int"))).drop("__place")


def copies(utterances: DataFrame, replicas: int, prefix: str = "rvb", original: bool = False) -> DataFrame:
    """``utterances`` (utt, ...) as often as asked, with ``copy`` and ``name``: the prefix, the copy's number, a dash and the utterance; copy 0 is the original."""
    name = F.concat(F.lit(prefix), F.col("copy").cast("string"), F.lit("-"), F.col("utt").cast("string"))
    return utterances.withColumn("copy", F.explode(F.sequence(F.lit(0 if original else 1), F.lit(replicas)))).withColumn("name", name)


def reverberated(named: DataFrame, rooms: DataFrame, speech: float = 1.0) -> DataFrame:
    """``named`` (name, ...) with the room and impulse response of ``rooms`` (rir, room, probability), and ``wet``: whether speech goes through it."""
    d = picked(named.withColumn("__u", chance(F.col("name"), seed="rir")), "__u", rooms.select("rir", "room", "probability"), "rir")
    return d.drop("__u").withColumn("wet", chance(F.col("name"), seed="wet") < speech)


def noises_added(wet: DataFrame, noises: DataFrame, rooms: DataFrame, foreground: Sequence[float], background: Sequence[float], share: float = 1.0, per_minute: float = 2.0) -> DataFrame:
    """(name, k, noise, kind, rir, start, snr): point noises of copies (name, room, dur), ``per_minute`` at most of each.

    ``noises``: (noise, kind, probability), kind foreground or background.  Each goes through an impulse response of the copy's room; a
    background noise begins at 0 and lasts as long as the speech, one in the foreground begins anywhere.  Ratios to speech
    are taken in turn, of the kind's own list.
    """
    most = F.floor(F.lit(per_minute) * F.col("dur") / 60).cast("int")
    some = wet.withColumn("__most", most).filter((F.col("__most") >= 1) & (chance(F.col("name"), seed="noisy") < share))
    count = F.floor(chance(F.col("name"), seed="count") * F.col("__most")).cast("int") + 1
    d = some.select("name", "room", "dur", F.explode(F.sequence(F.lit(1), count)).alias("k"))
    d = picked(d.withColumn("__u", chance(F.col("name"), F.col("k"), seed="noise")), "__u", noises.select("noise", "kind", "probability"), "noise").drop("__u")
    w = W.partitionBy("room").orderBy("rir").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = F.sum(F.col("probability").cast(EXACT))
    line = written(rooms.filter("probability > 0").select("room", "rir", (own.over(w).cast("double") / own.over(W.partitionBy("room")).cast("double")).alias("__to")))
    by = W.partitionBy("room").orderBy("rir")
    line = line.select("room", "rir", F.coalesce(F.lag("__to").over(by), F.lit(0.0)).alias("__from"), F.when(F.lead("rir").over(by).isNull(), 2.0).otherwise(F.col("__to")).alias("__to"))
    d = _looked_up(d.withColumn("__u", chance(F.col("name"), F.col("k"), seed="noise rir")), "__u", line, ["room"])
    front = F.col("kind") == "foreground"
    d = d.select("name", "k", "noise", "kind", "rir", F.when(front, F.round(chance(F.col("name"), F.col("k"), seed="start") * F.col("dur"), 2)).otherwise(0.0).alias("start"))
    d = written(d)  # numbered twice, by kind
    return cyclic(d.filter(front), ["name", "k"], foreground, "snr", "foreground").unionByName(cyclic(d.filter(~front), ["name", "k"], background, "snr", "background"))

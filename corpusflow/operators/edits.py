"""Word alignments of hypothesis and reference, what can be read from them, and augmented copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import kernels
from corpusflow.functions.arrow import by_row
from corpusflow.session import ship

#: Pairs of texts whose similarities are remembered within a batch: names come again and again.
KNOWN_PAIRS = 10_000


def aligned_words(df: DataFrame, ref: str, hyp: str) -> Column:
    """array<struct(ref, hyp, op)> of a cheapest word alignment; op is C, S, I or D, a null side is a gap."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    kind = pa.list_(pa.struct([("ref", pa.string()), ("hyp", pa.string()), ("op", pa.string())]))

    @arrow_udf("array<struct<ref:string,hyp:string,op:string>>")
    def run(refs: pa.Array, hyps: pa.Array) -> pa.Array:
        return by_row(lambda r, h: [dict(zip(("ref", "hyp", "op"), x, strict=True)) for x in kernels.edit_operations((r or "").split(), (h or "").split())], kind, refs, hyps)

    return run(F.col(ref), F.col(hyp))


def edit_counts(ops: Column) -> Column:
    """struct(c, s, i, d) of an alignment."""
    return F.struct(*[F.size(F.filter(ops, _is(k.upper()))).alias(k) for k in "csid"])


def similarities(df: DataFrame, a: str, b: str, names: Sequence[str]) -> Column:
    """struct of similarities (``kernels.SIMILARITIES``) of two texts, from 0 to 1; null texts count as empty."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    chosen = {n: kernels.SIMILARITIES[n] for n in names}
    kind = pa.struct([(n, pa.float64()) for n in chosen])

    def told(x: str | None, y: str | None) -> dict[str, float]:
        return {n: float(f(x or "", y or "")) for n, f in chosen.items()}

    @arrow_udf(f"struct<{','.join(f'{n}:double' for n in chosen)}>")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return by_row(lru_cache(maxsize=KNOWN_PAIRS)(told), kind, left, right)

    return run(F.col(a), F.col(b))


def letter_pairs(df: DataFrame, query: str, text: str) -> Column:
    """map<string, bigint>: letters set against each other in the local alignment of two texts, the smaller first."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    kind = pa.map_(pa.string(), pa.int64())

    @arrow_udf("map<string,bigint>")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return by_row(lambda x, y: sorted(kernels.local_align(x or "", y or "", 0, len(y or ""))[3].items()), kind, left, right)

    return run(F.col(query), F.col(text))


def _is(op: str):
    return lambda x: x["op"] == op


#: Distinct words that ``word_distance`` tells apart: as many characters as there are from U+0100 on, without the surrogates.
MOST_WORDS = 0x110000 - 0x100 - 0x800


def word_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two word arrays without Python: each distinct word becomes one character; null for a null array.

    More than ``MOST_WORDS`` distinct words in the two arrays together are an error.
    """
    table = F.array_distinct(F.concat(a, b))
    code = lambda n: F.when(n < 0xD800, n).otherwise(n + 0x800)  # noqa: E731  past the surrogates
    letter = lambda n: F.decode(F.unhex(F.lpad(F.hex(code(n)), 8, "0")), "UTF-32")
    letters = F.map_from_arrays(table, F.transform(table, lambda w, i: letter(i + 0x100)))
    small = F.when(F.size(table) <= MOST_WORDS, F.lit(True)).otherwise(F.raise_error(F.lit(f"more than {MOST_WORDS} distinct words")).cast("boolean"))
    text = lambda ws, m: F.array_join(F.transform(ws, lambda w: F.element_at(m, w)), "")
    return F.when(small, F.element_at(F.transform(F.array(letters), lambda m: F.levenshtein(text(a, m), text(b, m))), 1))


def better_halves(edits: DataFrame, recording: str = "recording") -> DataFrame:
    """Of neighbouring segments (recording, utt, start, end, errors, words) that overlap, the one with the lower error rate has the overlap.

    Returns the segments with ``from`` and ``to``: the part of each that is its own.
    """
    w = W.partitionBy(recording).orderBy("start", "end", "utt")
    rate = F.col("errors") / F.greatest(F.col("words"), F.lit(1))
    d = edits.withColumn("rate", rate)
    for name, step in (("before", F.lag), ("after", F.lead)):
        d = d.withColumn(name, step(F.struct("start", "end", "rate")).over(w))
    first = F.when((F.col("before.end") > F.col("start")) & (F.col("before.rate") <= F.col("rate")), F.col("before.end")).otherwise(F.col("start"))
    last = F.when((F.col("after.start") < F.col("end")) & (F.col("after.rate") < F.col("rate")), F.col("after.start")).otherwise(F.col("end"))
    return d.select(*edits.columns, first.alias("from"), F.greatest(first, last).alias("to"))


def forgiven(edits: DataFrame, unscored: Sequence[str]) -> DataFrame:
    """Edits (hyp, ref, edit_type) in which errors that concern only unscored words become ``fix`` and the reference follows."""
    odd = lambda c: F.coalesce(F.col(c).isin(*unscored), F.lit(False))
    soft = ((F.col("edit_type") == "ins") & odd("hyp")) | ((F.col("edit_type") == "del") & odd("ref")) | ((F.col("edit_type") == "sub") & odd("hyp") & odd("ref"))
    return edits.withColumn("ref", F.when(soft, F.col("hyp")).otherwise(F.col("ref"))).withColumn("edit_type", F.when(soft, F.lit("fix")).otherwise(F.col("edit_type")))


def repetitions_fixed(edits: DataFrame, unscored: Sequence[str] = (), key: str = "utt", order: str = "pos", silence: str = "<eps>") -> DataFrame:
    """Edits (utt, pos, hyp, ref, edit_type) in which inserted repetitions of one or two correct words become correct.

    Lines whose words on both sides are silence or not scored don't come between; a spoken word in place of one that is not
    scored counts as inserted.  Words of an utterance are gone through in order (``kernels.repeated``).
    """
    ship(edits.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<int>")
    def found(hyps: pa.Array, kinds: pa.Array) -> pa.Array:
        return by_row(lambda h, k: kernels.repeated(h or [], k or []), pa.list_(pa.int32()), hyps, kinds)

    silent = lambda c: F.coalesce(F.col(c).isin(silence, *unscored), F.lit(True))
    kind = F.when((F.col("edit_type") == "sub") & silent("ref"), F.lit("ins")).otherwise(F.col("edit_type"))
    told = edits.filter(~(silent("hyp") & silent("ref")))
    per = told.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("hyp", F.lit(silence)).alias("h"), kind.alias("k")))).alias("rows"))
    field = lambda n: F.transform("rows", lambda x: x[n])
    per = per.select(key, field("o").alias("o"), field("h").alias("h"), field("k").alias("k"))
    fixed = per.withColumn("at", found("h", "k")).select(F.col(key).alias("__key"), F.explode(F.transform("at", lambda i: F.get("o", i))).alias("__order"))
    both = edits.join(fixed.withColumn("__fixed", F.lit(True)), (F.col(key) == F.col("__key")) & (F.col(order) == F.col("__order")), "left")
    hit = F.coalesce("__fixed", F.lit(False))
    return both.withColumn("ref", F.when(hit, F.col("hyp")).otherwise(F.col("ref"))).withColumn("edit_type", F.when(hit, F.lit("cor")).otherwise(F.col("edit_type"))).select(*edits.columns)


def spoken_column(df: DataFrame, text: str) -> Column:
    """English with numbers, ordinals and money in words (``kernels.spoken``)."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else kernels.spoken(t) for t in texts.to_pylist()], pa.string())

    return run(F.col(text))


def clean_cores(edits: DataFrame, key: str = "utt", order: str = "pos", least: float = 0.5, pad: float = 0.05, max_error_share: float = 0.0) -> DataFrame:
    """Segments (utt, start, end, text) around maximal runs without errors, from edits (utt, pos, start, dur, ref, edit_type, tainted).

    A run is padded on both sides by at most ``pad`` and by half of what lies between it and the next run;
    runs shorter than ``least`` go.
    """
    bad = F.col("edit_type").isin("ins", "sub", "del") | F.col("tainted")
    w = W.partitionBy(key).orderBy(order)
    d = edits.withColumn("__bad", bad).withColumn("__turn", F.coalesce((F.col("__bad") != F.lag("__bad").over(w)).cast("int"), F.lit(0))).withColumn("__run", F.sum("__turn").over(w))
    spoken = F.filter(F.array_sort(F.collect_list(F.struct(order, F.col("ref").alias("ref"), F.col("edit_type").alias("t")))), lambda x: (x["t"] != "sil") & x["ref"].isNotNull())
    runs = d.filter(~F.col("__bad")).groupBy(key, "__run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("dur")).alias("end"), F.array_join(F.transform(spoken, lambda x: x["ref"]), " ").alias("text"))
    runs = runs.filter((F.col("text") != "") & (F.col("end") - F.col("start") >= least))
    n = W.partitionBy(key).orderBy("start")
    room = lambda c, sign: F.least(F.lit(pad), F.coalesce(sign * c / 2, F.lit(pad)))
    before = room(F.col("start") - F.lag("end").over(n), F.lit(1.0))
    after = room(F.lead("start").over(n) - F.col("end"), F.lit(1.0))
    return runs.select(key, F.greatest(F.lit(0.0), F.col("start") - before).alias("start"), (F.col("end") + after).alias("end"), "text")


def stitched(slices: DataFrame, docs: DataFrame) -> DataFrame:
    """(query, text) from slices (query, place, doc, first, last) of documents (doc, words): shares of each, in order.

    first is the share left out at the beginning, last the share left out at the end.
    """
    n = F.size("words")
    a, b = F.floor(F.col("first") * n).cast("int"), F.floor(F.col("last") * n).cast("int")
    part = F.slice("words", a + 1, F.greatest(F.lit(0), n - a - b))
    j = slices.join(docs, "doc").select("query", "place", part.alias("part"))
    rows = F.array_sort(F.collect_list(F.struct("place", "part")))
    return j.groupBy("query").agg(F.array_join(F.flatten(F.transform(rows, lambda x: x["part"])), " ").alias("text"))


def perturbed(df: DataFrame, key: str, duration: str, speeds: Sequence[float] = (0.9, 1.0, 1.1), volumes: tuple[float, float] | None = None, seed: str = "perturb") -> DataFrame:
    """A copy of each utterance for each speed, its duration changed; a volume between the bounds from a seeded digest."""
    rows = F.array(*[F.struct(F.lit(s).alias("speed")) for s in speeds])
    out = df.select("*", F.inline(rows)).withColumn("name", F.when(F.col("speed") == 1.0, F.col(key).cast("string")).otherwise(F.concat(F.lit("sp"), F.col("speed").cast("string"), F.lit("-"), F.col(key).cast("string")))).withColumn(duration, F.col(duration) / F.col("speed"))
    if volumes:
        share = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), "name").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)
        out = out.withColumn("volume", F.lit(volumes[0]) + share * (volumes[1] - volumes[0]))
    return out

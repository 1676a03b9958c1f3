"""Long recordings with imprecise transcripts, cut to segments with the text that fits them, in written stages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import corpus as C
from corpusflow.operators import edits as E
from corpusflow.operators import segments as G
from corpusflow.operators import sequences as S
from corpusflow.plans.stages import Stage, run
from corpusflow.session import shuffled_joins, tasks


@dataclass(frozen=True)
class LongForm:
    """Windows in seconds; ``decode`` (windows, models) -> (recording, window, start, dur, word) reads a recording again with each window's biased model."""

    window: float = 30.0
    overlap: float = 5.0
    document_words: int = 1000
    neighbours: int = 1
    factor: float = 0.9
    part: float = 0.2
    correct: int = 1
    penalty: int = 1
    rules: G.SegmentRules = field(default_factory=G.SegmentRules)
    decode: Callable[[DataFrame, DataFrame], DataFrame] | None = None


def windows(words: DataFrame, c: LongForm) -> DataFrame:
    """(recording, window, start, dur, word): words by overlapping windows of equal length; a word is in each in which it begins."""
    step = c.window - c.overlap
    first = F.greatest(F.lit(0), F.floor((F.col("start") - c.window) / step) + 1).cast("int")
    return words.select("recording", F.explode(F.sequence(first, F.floor(F.col("start") / step).cast("int"))).alias("window"), "start", "dur", "word")


def documents(transcripts: DataFrame, c: LongForm) -> DataFrame:
    """(recording, place, doc, words): transcripts cut into documents."""
    cut = transcripts.withColumn("__words", X.words(F.lower("text"))).select("recording", F.posexplode(S.split_documents(F.col("__words"), c.document_words)).alias("place", "words"))
    return cut.withColumn("doc", F.concat_ws("#", F.col("recording").cast("string"), F.col("place").cast("string")))


def scores(heard: DataFrame, docs: DataFrame) -> DataFrame:
    """(recording, window, place, score): windows against the documents of their own recording, by TF-IDF."""
    asked = heard.filter(F.col("word") != G.EPS).groupBy("recording", "window", F.lower("word").alias("term")).agg(F.count("*").alias("q"))
    weights = C.tf_idf(docs.select("doc", F.array_join("words", " ").alias("text")), "doc", "text", only=asked)
    of_place = docs.select("doc", "recording", "place").join(weights, "doc")
    return asked.join(of_place, ["recording", "term"]).groupBy("recording", "window", "place").agg(F.sum(F.col("q") * F.col("weight")).alias("score"))


def references(scored: DataFrame, docs: DataFrame, c: LongForm) -> DataFrame:
    """(query, text): the best document of each window with what touches it, put together."""
    query = F.struct("recording", "window")
    taken = C.retrieved(scored.select(query.alias("query"), "place", "score"), c.neighbours, c.factor, c.part)
    part = lambda first, last, when: F.when(when, F.struct(first.alias("first"), last.alias("last")))
    none = F.lit(0.0)
    whole = (F.col("from_start") == 1) & (F.col("from_end") == 1)
    rows = F.array_compact(F.array(part(none, none, whole), part(none, 1 - F.col("from_start"), ~whole & (F.col("from_start") > 0)), part(1 - F.col("from_end"), none, ~whole & (F.col("from_end") > 0))))
    d = taken.select("query", "place", F.posexplode(rows).alias("side", "x")).join(docs.select(F.col("recording").alias("r"), F.col("place").alias("p"), "doc"), (F.col("query.recording") == F.col("r")) & (F.col("place") == F.col("p")))
    return E.stitched(d.select("query", F.struct("place", "side").alias("place"), "doc", "x.first", "x.last"), docs.select("doc", "words"))


def window_lines(heard: DataFrame, refs: DataFrame, c: LongForm) -> DataFrame:
    """(recording, window, pos, start, dur, hyp, ref, edit_type): each window's words aligned to its reference."""
    said = heard.groupBy(F.struct("recording", "window").alias("query")).agg(F.array_sort(F.collect_list(F.struct("start", "dur", F.lower("word").alias("word")))).alias("words"))
    d = said.join(refs.select("query", F.split("text", " ").alias("ref")), "query").repartition(tasks(heard.sparkSession))
    lines = G.locally_aligned(d, "ref", "words", c.correct, c.penalty, c.penalty, c.penalty, whole_hyp=True, first_pair=True)
    return d.select("query.*", F.posexplode(lines).alias("pos", "x")).select("recording", "window", "pos", "x.*")


def one_line_each(lines: DataFrame, c: LongForm) -> DataFrame:
    """Where windows overlap, the lines of the one with the lower error rate: (recording, pos, start, dur, hyp, ref, edit_type)."""
    error = F.col("edit_type").isin("ins", "del", "sub")
    step = c.window - c.overlap
    per = lines.groupBy("recording", F.col("window").alias("utt")).agg(F.count_if(error).alias("errors"), F.count_if(F.col("edit_type") != "sil").alias("words"))
    per = per.withColumn("start", F.col("utt") * step).withColumn("end", F.col("utt") * step + c.window)
    own = E.better_halves(per, "recording").select("recording", F.col("utt").alias("window"), "from", "to")
    mid = F.col("start") + F.col("dur") / 2
    kept = lines.join(own, ["recording", "window"]).filter((mid >= F.col("from")) & (mid < F.col("to")))
    return kept.select("recording", F.struct("start", "window", "pos").alias("pos"), "start", "dur", "hyp", "ref", "edit_type")


def marked(lines: DataFrame, c: LongForm) -> DataFrame:
    """Edits that are none after all forgiven, and what lies beside the others tainted."""
    unscored = c.rules.unscored
    fixed = E.repetitions_fixed(E.forgiven(lines, unscored), unscored, "recording", "pos")
    return S.tainted(fixed.withColumn("oov", F.lit(False)), "recording", "pos").drop("oov")


def long_form_stages(words: DataFrame, transcripts: DataFrame, c: LongForm = LongForm()) -> list[Stage]:
    """Timed words (recording, start, dur, word) and transcripts (recording, text) to segments."""

    def heard(spark, read):
        if c.decode is None:
            return read("windows")
        lines = read("references").select("query", "text")
        return c.decode(read("windows"), C.biased_model(lines, "query", "text"))

    return [
        Stage("windows", lambda spark, read: windows(words, c)),
        Stage("documents", lambda spark, read: documents(transcripts, c)),
        Stage("scores", lambda spark, read: scores(read("windows"), read("documents"))),
        Stage("references", lambda spark, read: references(read("scores"), read("documents"), c)),
        Stage("heard", heard),
        Stage("lines", lambda spark, read: window_lines(read("heard"), read("references"), c)),
        Stage("edits", lambda spark, read: marked(one_line_each(read("lines"), c), c)),
        Stage("segments", lambda spark, read: G.segments_of(read("edits"), c.rules, "recording")),
    ]


def segmented(spark: SparkSession, words: DataFrame, transcripts: DataFrame, folder: str, c: LongForm = LongForm()) -> DataFrame:
    """(recording, n, segment, start, end, text).  All tables of the stages grow with the recordings, so their joins shuffle."""
    with shuffled_joins(spark):
        return run(spark, long_form_stages(words, transcripts, c), folder)


def recall(segments: DataFrame, spoken: DataFrame) -> DataFrame:
    """(spoken, found): spoken words (recording, start, dur, word) and those of them that lie in a segment whose text has the word."""
    w = W.partitionBy("recording")
    d = spoken.select("recording", (F.col("start") + F.col("dur") / 2).alias("mid"), F.lower("word").alias("word")).withColumn("all", F.count("*").over(w))
    inside = d.join(segments.select("recording", F.col("start").alias("a"), F.col("end").alias("b"), F.split("text", " ").alias("text")), "recording").filter(F.col("mid").between(F.col("a"), F.col("b")) & F.array_contains("text", F.col("word")))
    return d.agg(F.count("*").alias("spoken")).crossJoin(inside.select("recording", "mid").distinct().agg(F.count("*").alias("found")))  # one row each

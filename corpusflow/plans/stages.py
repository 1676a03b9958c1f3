"""Staged runs: each stage's result is written, and a later run may begin at any stage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.functions import text as X
from corpusflow.operators import alignment as A
from corpusflow.operators import relational as R
from corpusflow.operators import sequences as S
from corpusflow.session import tasks
from corpusflow.sources import text_formats as T


@dataclass(frozen=True)
class Stage:
    """``make`` gets the session and a reader of earlier results by name."""

    name: str
    make: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]


def run(spark: SparkSession, stages: Sequence[Stage], folder: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Stages ``first`` to ``last``, each written as Parquet under ``folder``; the result of the last."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    last = len(stages) - 1 if last is None else last
    for stage in stages[first : last + 1]:
        stage.make(spark, read).write.mode("overwrite").parquet(f"{folder}/{stage.name}")
    return read(stages[last].name)


@dataclass(frozen=True)
class Corpus:
    """Where a speech corpus lies, and its bounds: least <= value < most."""

    catalogue: str
    words: str
    transcripts: str
    duplicates: str | None = None
    held_out: Sequence[str] = ()
    share_alike: bool = False
    cer: tuple[float, float] = (0.0, 36.0)
    duration_ms: tuple[int, int] = (1000, 15_000)
    fragment_ms: tuple[int, int] = (15_000, 3_000)


def corpus_stages(c: Corpus) -> list[Stage]:
    """Catalogue, word files and transcripts to a manifest; heavy work comes after all selections."""

    def mapping(spark, read):
        audio, text = A.candidates(T.catalogue(spark, c.catalogue))
        matched = A.match_documents(audio, text.drop("licenseurl"))
        return matched.join(text, ["identifier", "text_document_id"])

    def selected(spark, read):
        m = read("mapping")
        if c.duplicates:
            m = R.held_out(m, ["identifier", "text_document_id"], T.declared_json(spark, c.duplicates, schemas.MAPPING))
        if c.held_out:
            m = R.held_out(m, ["identifier", "text_document_id"], T.declared_json(spark, list(c.held_out), schemas.MAPPING))
        alike = F.col("licenseurl").rlike("by-sa")
        return m.filter(alike if c.share_alike else ~alike)

    def aligned(spark, read):
        m = read("selected").withColumn("utt", X.utterance_name(F.col("identifier"), F.col("audio_document_id")))
        ctm = T.files(spark, c.words, "*.ctm").select(X.stem(F.col("path")).alias("utt"), T.ctm_words(X.guess_text(F.col("content"))).alias("words"))
        texts = T.files(spark, c.transcripts).select(X.tail(F.col("path")).alias("text_document_id"), X.tail(F.col("path"), back=2).alias("identifier"), X.srt_text(X.guess_text(F.col("content"))).alias("transcript"))
        both = m.join(ctm, "utt").join(texts, ["identifier", "text_document_id"])
        both = both.withColumn("fragments", S.fragments(F.col("words"), *c.fragment_ms)).drop("words").repartition(tasks(spark))
        return A.all_in_time(A.align_table(both)).drop("fragments", "transcript")

    def manifest(spark, read):
        return A.manifest(A.kept_alignments(read("aligned"), *c.cer, *c.duration_ms))

    def trainer(spark, read):
        return A.trainer_manifest(read("manifest"))

    return [Stage(f.__name__, f) for f in (mapping, selected, aligned, manifest, trainer)]


def annotate(df: DataFrame, values: Mapping[str, str], forbidden: Sequence[str] = ("path", "text", "start", "end")) -> DataFrame:
    """Constant columns on all rows; names that mean something else are refused."""
    bad = set(values) & set(forbidden)
    if bad:
        raise ValueError(f"not to be set: {sorted(bad)}")
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def catalogue_of(frames: Sequence[DataFrame], root: str, order: Sequence[str]) -> DataFrame:
    """Union of path tables, paths made relative to ``root``, in order."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    prefix = root.rstrip("/") + "/"
    return out.select(*[F.when(F.startswith(F.col(c), F.lit(prefix)), F.substr(F.col(c), F.lit(len(prefix) + 1))).otherwise(F.col(c)).alias(c) for c in out.columns]).orderBy(*order)

"""Matching recordings to transcripts, and aligning recognised fragments to reference text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import kernels
from corpusflow.functions.arrow import by_row
from corpusflow.schemas import ALIGNMENT, MAPPING
from corpusflow.session import ship, tasks


def candidates(catalogue: DataFrame, audio_formats=("MP3", "VBR MP3"), audio_end: str = ".mp3", text_format: str = "SubRip") -> tuple[DataFrame, DataFrame]:
    """(identifier, audio_document_id) and (identifier, text_document_id, licenseurl) of a catalogue's usable files."""
    from corpusflow.operators.relational import usable_files

    files = usable_files(catalogue.select("identifier", F.col("metadata.licenseurl").alias("licenseurl"), F.explode("files").alias("f")).select("identifier", "licenseurl", "f.name", "f.format", "f.size", "f.private"))
    audio = files.filter(F.col("format").isin(*audio_formats) & F.col("name").endswith(audio_end)).select("identifier", F.col("name").alias("audio_document_id"))
    text = files.filter(F.col("format") == text_format).select("identifier", F.col("name").alias("text_document_id"), "licenseurl")
    return audio, text


def match_documents(audio: DataFrame, text: DataFrame) -> DataFrame:
    """One-to-one (identifier, audio_document_id, text_document_id): a stable matching by edit distance of the names."""
    ship(audio.sparkSession)
    n = tasks(audio.sparkSession)  # matching is long beside its rows: partitions by item are not put together
    pairs = audio.repartition(n, "identifier").join(text.repartition(n, "identifier"), "identifier")
    both = pairs.select("identifier", "audio_document_id", "text_document_id", F.levenshtein("audio_document_id", "text_document_id").alias("distance"))

    def match(group: pa.Table) -> pa.Table:
        item, left, right, distance = (group.column(c).to_pylist() for c in (*MAPPING.names, "distance"))
        cost = dict(zip(zip(left, right, strict=True), distance, strict=True))
        pairs = kernels.stable_match(sorted(set(left)), sorted(set(right)), lambda a, b: cost.get((a, b), cost.get((b, a))))
        columns = [item[:1] * len(pairs), [a for a, _ in pairs], [b for _, b in pairs]]
        return pa.Table.from_arrays([pa.array(c, pa.string()) for c in columns], names=MAPPING.names)

    return both.groupBy("identifier").applyInArrow(match, MAPPING)


@dataclass(frozen=True)
class Settings:
    """With ``snap``, ends of matches move to where they fit best (``kernels.snapped``).

    Bounds are (least, most) by metric: tlen, mlen, SWS, CER, WER or a name in ``kernels.SIMILARITIES``; None is no bound."""

    alphabet: str = " 'abcdefghijklmnopqrstuvwxyz"
    keep_dashes: bool = False
    candidates: int = 10
    ratio: float = 0.92
    match: int = 100
    mismatch: int = -100
    gap: int = -100
    bounds: Mapping[str, tuple[float | None, float | None]] = field(default_factory=lambda: {"tlen": (1, None), "mlen": (1, None)})
    seconds: float = 200.0
    snap: bool = False


def clean_with_places(text: str, settings: Settings) -> tuple[str, list[int]]:
    """The cleaned text and, for each of its characters, its place in the original."""
    out, places, spaced = [], [], True
    for i, c in enumerate(text):
        c = c.lower()
        if c == "-" and not settings.keep_dashes and "-" not in settings.alphabet:
            c = " "
        if c.isspace():
            if spaced:
                continue
            c, spaced = " ", True
        else:
            spaced = False
        if c in settings.alphabet:
            out.append(c)
            places.append(i)
    while out and out[-1] == " ":
        out.pop()
        places.pop()
    return "".join(out), places


def align_document(fragments: list[dict], transcript: str, settings: Settings) -> list[dict]:
    """Fragments (start, end, transcript) with a place in the transcript, and their measures, after all gates."""
    clean, places = clean_with_places(transcript, settings)
    if not clean:
        return []
    index = kernels.FuzzyText(clean, settings.candidates, settings.ratio, match=settings.match, mismatch=settings.mismatch, gap=settings.gap)
    said = [f["transcript"].strip() for f in fragments]
    found = [m for m in kernels.anchored(said, index) if m[1][1] > m[1][0]]
    spans = [(m[0], m[1]) for _, m in found]
    if settings.snap:
        spans = kernels.snapped([said[i] for i, _ in found], spans, clean)
    out = []
    for (i, (_, _, score, pairs)), (start, end) in zip(found, spans, strict=True):
        text = clean[start:end]
        if not text.split():
            continue
        measures = {
            "tlen": lambda: len(said[i]),  # noqa: B023
            "mlen": lambda: len(text),  # noqa: B023
            "SWS": lambda: 100 * score,  # noqa: B023
            "CER": lambda: 100 * kernels.edit_distance(said[i], text) / len(text),  # noqa: B023
            "WER": lambda: 100 * kernels.edit_distance(said[i].split(), text.split()) / len(text.split()),  # noqa: B023
        }
        measures |= {n: (lambda f=f: 100 * f(text, said[i])) for n, f in kernels.SIMILARITIES.items()}  # noqa: B023
        if any((low is not None and v < low) or (high is not None and v > high) for n, (low, high) in settings.bounds.items() for v in [measures[n]()]):
            continue
        original_end = places[end] if end < len(places) else len(transcript)
        out.append({"start": fragments[i]["start"], "end": fragments[i]["end"], "label": text, "hypothesis": said[i], "cer": measures["CER"](), "wer": measures["WER"](), "score": score, "text_start": places[start], "text_end": original_end, "pairs": pairs})
    return out


def align_table(docs: DataFrame, fragments: str = "fragments", transcript: str = "transcript", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``alignments``: a struct of parallel arrays, and ``timed_out``: whether the document took longer than
    ``settings.seconds``, in which case the arrays are null, not empty.

    ``fragments``: array<struct(start, end, transcript)>, as ``sequences.fragments`` makes them.
    """
    ship(docs.sparkSession)
    from pyspark.sql.functions import arrow_udf

    names = ALIGNMENT.names

    @arrow_udf(ALIGNMENT)
    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def told(f: list[dict] | None, t: str | None) -> dict | None:
            found = _in_time(lambda: align_document(f or [], t or "", settings), settings.seconds)
            return None if found is None else dict(zip(names, ([x[k] for x in found] for k in ("start", "end", "label", "cer", "wer", "hypothesis")), strict=True))

        for frags, texts in parts:
            yield by_row(told, pa.struct([pa.field(f.name, {"bigint": pa.list_(pa.int64()), "string": pa.list_(pa.string()), "float": pa.list_(pa.float32())}[f.dataType.elementType.simpleString()]) for f in ALIGNMENT.fields]), frags, texts)

    return docs.withColumn("alignments", run(F.col(fragments), F.col(transcript))).withColumn("timed_out", F.col("alignments").isNull())


def all_in_time(aligned: DataFrame) -> DataFrame:
    """What ``align_table`` gives; a document that took too long is an error, not a document without alignments."""
    late = F.raise_error(F.lit("a document took longer to align than Settings.seconds allows"))
    return aligned.withColumn("alignments", F.when(~F.col("timed_out"), F.col("alignments")).otherwise(late.cast(ALIGNMENT)))


def _in_time(work, seconds: float) -> list | None:
    """``work()``, or None if it takes longer (checked in the worker's main thread by an alarm)."""
    import signal
    import threading

    if threading.current_thread() is not threading.main_thread() or seconds <= 0:
        return work()

    def stop(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return work()
    except TimeoutError:
        return None
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def kept_alignments(df: DataFrame, min_cer: float, max_cer: float, min_ms: int, max_ms: int, col: str = "alignments") -> DataFrame:
    """Elements of ``alignments`` with least <= value < most for character error rate and duration; documents left empty stay."""
    a = F.arrays_zip(*[F.col(f"{col}.{n}").alias(n) for n in ("start_ms", "end_ms", "label", "cer", "wer")])
    rows = F.transform(a, lambda x: F.struct(x["start_ms"].alias("start_ms"), x["end_ms"].alias("end_ms"), x["label"].alias("label"), x["cer"].alias("cer"), x["wer"].alias("wer"), (x["end_ms"] - x["start_ms"]).alias("duration_ms")))
    good = F.filter(rows, lambda x: (x["duration_ms"] >= min_ms) & (x["duration_ms"] < max_ms) & (x["cer"] >= min_cer) & (x["cer"] < max_cer))
    return df.withColumn(col, good)


def manifest(df: DataFrame, suffix: str = "flac", col: str = "alignments") -> DataFrame:
    """(identifier, audio_document_id, text_document_id, training_data{duration_ms, label, name}) from kept alignments."""
    from corpusflow.functions.text import chunk_names, file_key

    names = chunk_names(F.concat_ws("/", file_key(F.col("identifier")), file_key(F.col("audio_document_id"))), F.size(col), suffix)
    data = F.struct(F.transform(col, lambda x: x["duration_ms"]).alias("duration_ms"), F.transform(col, lambda x: x["label"]).alias("label"), names.alias("name"))
    return df.filter(F.size(col) > 0).select(*MAPPING.names, data.alias("training_data"))


def trainer_manifest(man: DataFrame, folder: str = "") -> DataFrame:
    """A row a chunk: audio_filepath, text, duration in seconds, shard_id -1."""
    flat = man.select(F.inline(F.arrays_zip("training_data.name", "training_data.label", "training_data.duration_ms")))
    return flat.select(F.concat(F.lit(folder), "name").alias("audio_filepath"), F.col("label").alias("text"), (F.col("duration_ms") / 1000.0).alias("duration"), F.lit(-1).alias("shard_id"))

"""WAV audio as bytes: headers, slices, voice activity. Other codecs need a decoder that is not part of this engine."""

from __future__ import annotations

import io
import struct
import wave
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import ship, tasks


def wav_info(data: bytes | None) -> tuple[int, int, int, float] | None:
    """(rate, channels, bytes a sample, seconds), or nothing for what is no WAV."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            return w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, struct.error, ZeroDivisionError):
        return None


def make_wav(samples: np.ndarray, rate: int = 16_000) -> bytes:
    """A mono 16-bit WAV of samples from -1 to 1."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def slices(data: bytes, spans_ms: list[tuple[int, int]]) -> list[bytes]:
    """WAVs of spans of a WAV."""
    with wave.open(io.BytesIO(data)) as w:
        params, frames = w.getparams(), w.readframes(w.getnframes())
    size = params.sampwidth * params.nchannels
    out = []
    for a, b in spans_ms:
        piece = io.BytesIO()
        with wave.open(piece, "wb") as w:
            w.setparams(params)
            w.writeframes(frames[a * params.framerate // 1000 * size : b * params.framerate // 1000 * size])
        out.append(piece.getvalue())
    return out


class SpanFinder:
    """Spans (start, end) in ms, from frames that come in piece by piece: a span opens when more than ``share`` of the last
    ``padding`` frames are voiced, and closes when more than ``share`` of them are not; it begins with the frames that opened it."""

    def __init__(self, frame_ms: int = 30, padding: int = 10, share: float = 0.5) -> None:
        self.frame_ms, self.most = frame_ms, share * padding
        self.frames, self.open_at, self.recent = 0, None, deque(maxlen=padding)

    def feed(self, voiced: Iterable[bool]) -> list[tuple[int, int]]:
        """The spans that these frames close."""
        out, recent = [], self.recent
        loud = sum(recent)
        for v in map(bool, voiced):
            if len(recent) == recent.maxlen:
                loud -= recent[0]
            recent.append(v)
            loud += v
            self.frames += 1
            if self.open_at is None and loud > self.most:
                self.open_at, loud = self.frames - len(recent), 0
                recent.clear()
            elif self.open_at is not None and len(recent) - loud > self.most:
                out.append((self.open_at * self.frame_ms, self.frames * self.frame_ms))
                self.open_at, loud = None, 0
                recent.clear()
        return out

    def end(self) -> list[tuple[int, int]]:
        """The span that is open at the end."""
        return [] if self.open_at is None else [(self.open_at * self.frame_ms, self.frames * self.frame_ms)]


def voiced_spans(voiced: np.ndarray, frame_ms: int = 30, padding: int = 10, share: float = 0.5) -> list[tuple[int, int]]:
    """Spans of all frames of a recording."""
    found = SpanFinder(frame_ms, padding, share)
    return found.feed(voiced) + found.end()


def _samples(data: bytes) -> tuple[np.ndarray, int]:
    """Samples of a 16-bit WAV, its channels' mean, from -1 to 1; and the rate."""
    with wave.open(io.BytesIO(data)) as w:
        return np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(axis=1) / 32768, w.getframerate()


def _loud(x: np.ndarray, n: int, threshold: float) -> np.ndarray:
    x = x[: len(x) // n * n].reshape(-1, n)
    return np.sqrt((x * x).mean(axis=1)) > threshold


def loud_frames(data: bytes, frame_ms: int = 30, threshold: float = 0.01) -> np.ndarray:
    """Frames of a 16-bit WAV whose root mean square is above ``threshold`` of full scale."""
    x, rate = _samples(data)
    return _loud(x, rate * frame_ms // 1000, threshold)


def voiced_recordings(pieces: Iterable[tuple[object, bytes]], frame_ms: int = 30, threshold: float = 0.01) -> Iterator[tuple[object, list[tuple[int, int]]]]:
    """(key, spans) of recordings that come as WAVs (key, piece), a recording's pieces one after the other: a piece is held at a time."""
    for key, own in groupby(pieces, key=lambda p: p[0]):
        found, rest, spans = SpanFinder(frame_ms), np.zeros(0), []
        for _, data in own:
            x, rate = _samples(data)
            x, n = np.concatenate([rest, x]), rate * frame_ms // 1000
            spans += found.feed(_loud(x, n, threshold).tolist())
            rest = x[len(x) // n * n :]
        yield key, spans + found.end()


#: Rows that are made to audio at a time.
PIECE = 64


def audio_rows(df: DataFrame, fields: str, schema: pa.Schema, rows: Callable[[dict], Iterable[dict]]) -> DataFrame:
    """The rows that ``rows`` makes of each row; results leave in pieces, so that a task's audio has a bound whatever the batches of the session.

    Rows that audio is made of are short and the work on them is long, so they are dealt out to as many tasks as the session shuffles to.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PIECE):
                yield pa.RecordBatch.from_pylist([x for r in b.slice(at, PIECE).to_pylist() for x in rows(r)], schema)

    return df.repartition(tasks(df.sparkSession)).mapInArrow(run, fields)


def _per_row(df: DataFrame, content: str, fields: str, kernel, kind: pa.DataType) -> DataFrame:
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    @arrow_udf(fields)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in parts:
            yield pa.array((kernel(x.as_py()) for x in a), kind, size=len(a))  # one recording is taken out at a time

    return run(F.col(content))


def info_column(df: DataFrame, content: str = "content") -> Column:
    """struct(rate, channels, width, seconds); null for what is no WAV."""
    kind = pa.struct([("rate", pa.int32()), ("channels", pa.int32()), ("width", pa.int32()), ("seconds", pa.float64())])
    make = lambda b: (lambda i: None if i is None else dict(zip(("rate", "channels", "width", "seconds"), i, strict=True)))(wav_info(b))
    return _per_row(df, content, "rate int, channels int, width int, seconds double", make, kind)


def voice_column(df: DataFrame, content: str = "content", frame_ms: int = 30, threshold: float = 0.01) -> Column:
    """struct(start_ms, end_ms, voiced): voiced spans and their audio; null for what is no WAV."""
    kind = pa.struct([("start_ms", pa.list_(pa.int32())), ("end_ms", pa.list_(pa.int32())), ("voiced", pa.list_(pa.binary()))])

    def make(b):
        if wav_info(b) is None:
            return None
        spans = voiced_spans(loud_frames(b, frame_ms, threshold), frame_ms)
        return {"start_ms": [a for a, _ in spans], "end_ms": [e for _, e in spans], "voiced": slices(b, spans)}

    return _per_row(df, content, "start_ms array<int>, end_ms array<int>, voiced array<binary>", make, kind)

"""Archives: a ``tar`` data source that reads and writes, WARC responses, and sharded export."""

from __future__ import annotations

import gzip
import io
import json
import struct
import tarfile
from collections.abc import Iterable, Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from corpusflow.session import ship, tasks


def read_tar(spark: SparkSession, path: str, value: bool = True, glob: str = "*.tar*") -> DataFrame:
    """(key, value) of every file in tar archives, compressed or not; without ``value`` only headers are looked at.

    Archives come through Spark's own binary reader, so any store that Spark knows will do; one is one task's work.
    """
    ship(spark)
    schema = "key string, value binary" if value else "key string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r:*") as tar:
                    for member in tar:
                        if member.isfile():
                            cols = [pa.array([member.name])]
                            if value:
                                cols.append(pa.array([tar.extractfile(member).read()], pa.binary()))
                            yield pa.RecordBatch.from_arrays(cols, names=["key", "value"][: len(cols)])

    content = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("content")
    return content.mapInArrow(run, schema)


def _mounted(path: str) -> str:
    """A path that ``open`` takes: without ``file:``; other stores must be mounted."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


class _Written(WriterCommitMessage):
    def __init__(self, name: str) -> None:
        self.name = name


class _ArchiveWriter(DataSourceWriter):
    """One file a task, under a temporary name until the job commits; the path is a mount that all executors share."""

    end = ""

    def __init__(self, path: str, overwrite: bool, options: dict) -> None:
        self.path, self.overwrite, self.options = _mounted(path), overwrite, dict(options)

    def put(self, path: str, rows) -> None:
        raise NotImplementedError

    def write(self, iterator):
        import os
        import uuid

        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{self.end}"
        self.put(os.path.join(self.path, f"._{name}"), iterator)
        return _Written(name)

    def commit(self, messages):
        import os

        kept = {m.name for m in messages if m}
        if self.overwrite:
            for f in os.listdir(self.path):
                if f.lstrip("._") not in kept and f.lstrip("._").startswith("part-"):
                    os.remove(os.path.join(self.path, f))
        for name in kept:
            os.replace(os.path.join(self.path, f"._{name}"), os.path.join(self.path, name))

    def abort(self, messages):
        import os

        for m in messages:
            if m and os.path.exists(os.path.join(self.path, f"._{m.name}")):
                os.remove(os.path.join(self.path, f"._{m.name}"))


class _TarWriter(_ArchiveWriter):
    @property
    def end(self) -> str:
        codec = self.options.get("codec", "")
        return ".tar" + (f".{codec}" if codec else "")

    def put(self, path: str, rows) -> None:
        with tarfile.open(path, f"w:{self.options.get('codec', '')}", format=tarfile.PAX_FORMAT) as tar:
            for row in rows:
                info = tarfile.TarInfo(row.key)
                info.size = len(row.value or b"")
                tar.addfile(info, io.BytesIO(row.value or b""))


class _SampleWriter(_ArchiveWriter):
    end = ".sdb"

    def put(self, path: str, rows) -> None:
        with open(path, "wb") as out:
            put_samples(out, ((row.audio or b"", row.transcript or "") for row in rows), self.options.get("audio_type", "audio/wav"))


class _MountReader(DataSourceReader):
    """Archives of a mounted folder, a partition each."""

    def __init__(self, path: str, end: str, rows) -> None:
        self.path, self.end, self.rows = _mounted(path), end, rows

    def partitions(self):
        import os

        names = [self.path] if os.path.isfile(self.path) else sorted(os.path.join(self.path, f) for f in os.listdir(self.path) if self.end in f and not f.startswith((".", "_")))
        return [InputPartition(n) for n in names]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            yield from self.rows(f.read())


class TarSource(DataSource):
    """``format("tar")`` of (key, value), to read and to write; option ``codec``: gz, bz2 or xz. For paths on a shared mount."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return "key string, value binary"

    def reader(self, schema) -> DataSourceReader:
        return _MountReader(self.options["path"], ".tar", _tar_rows)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if [f.name for f in schema.fields] != ["key", "value"]:
            raise ValueError("a tar archive is made of (key, value)")
        return _TarWriter(self.options["path"], overwrite, self.options)


class SampleSource(DataSource):
    """``format("sdb")`` of (audio, transcript): sample databases, to read and to write; option ``audio_type``."""

    @classmethod
    def name(cls) -> str:
        return "sdb"

    def schema(self) -> str:
        return "audio binary, transcript string"

    def reader(self, schema) -> DataSourceReader:
        return _MountReader(self.options["path"], ".sdb", get_samples)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _SampleWriter(self.options["path"], overwrite, self.options)


class _FileWriter(_ArchiveWriter):
    """A file for each row, under its own name; the same row written again replaces it."""

    def write(self, iterator):
        import os

        for row in iterator:
            path = os.path.join(self.path, row.name.lstrip("/"))
            os.makedirs(os.path.dirname(path), exist_ok=True)
            made = f"{path}._{os.getpid()}"
            with open(made, "wb") as out:
                out.write(row.value or b"")
            os.replace(made, path)
        return _Written("")

    def commit(self, messages):
        pass

    def abort(self, messages):
        pass


class FileSink(DataSource):
    """``format("files")`` of (name, value), to write: a file a row.  For paths on a shared mount."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "name string, value binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _FileWriter(self.options["path"], overwrite, self.options)


def write_files(df: DataFrame, path: str) -> None:
    """Each row's ``value`` in a file of its ``name`` below ``path``."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(FileSink)
    df.select("name", "value").repartition(tasks(df.sparkSession)).write.format("files").mode("append").save(path)


def _tar_rows(data: bytes) -> Iterator[tuple[str, bytes]]:
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as tar:
        for member in tar:
            if member.isfile():
                yield member.name, tar.extractfile(member).read()


# The sample database's mark, its header's keys, and its big-endian numbers of 4 and 8 bytes.
SAMPLE_MARK, SCHEMA_KEY, SPEECH, TRANSCRIPT, TEXT = b"SAMPLEDB", "schema", "speech", "transcript", "text/plain"
_SHORT, _LONG = struct.Struct(">I"), struct.Struct(">Q")


def put_samples(out, samples: Iterable[tuple[bytes, str]], audio_type: str) -> None:
    """Header, length-prefixed rows of length-prefixed cells, and an index of where rows begin."""
    head = json.dumps({SCHEMA_KEY: [{"content": SPEECH, "mime-type": audio_type}, {"content": TRANSCRIPT, "mime-type": TEXT}]}).encode()
    out.write(SAMPLE_MARK + _LONG.pack(len(head)) + head)
    body = out.tell()
    out.write(_LONG.pack(0) * 2)
    places = []
    for audio, text in samples:
        cells = b"".join(_SHORT.pack(len(c)) + c for c in (audio, text.encode()))
        places.append(out.tell())
        out.write(_SHORT.pack(len(cells)) + cells)
    index = out.tell()
    out.write(_LONG.pack(8 * (len(places) + 1)) + b"".join(map(_LONG.pack, (len(places), *places))))
    out.seek(body)
    out.write(_LONG.pack(index - body - 8) + _LONG.pack(len(places)))


def get_samples(data: bytes) -> Iterator[tuple[bytes, str]]:
    """(audio, transcript) of a sample database, by its header's column order."""
    if data[:8] != SAMPLE_MARK:
        raise ValueError("not a sample database")
    (size,) = _LONG.unpack_from(data, 8)
    kinds = [c["content"] for c in json.loads(data[16 : 16 + size])[SCHEMA_KEY]]
    (rows,) = _LONG.unpack_from(data, 16 + size)
    index = 24 + size + rows + 8
    (n,) = _LONG.unpack_from(data, index)
    for i in range(n):
        (at,) = _LONG.unpack_from(data, index + 8 * (i + 1))
        at, cells = at + 4, []
        for _ in kinds:
            (length,) = _SHORT.unpack_from(data, at)
            cells.append(data[at + 4 : at + 4 + length])
            at += 4 + length
        yield cells[kinds.index(SPEECH)], cells[kinds.index(TRANSCRIPT)].decode()


def write_samples_by_duration(df: DataFrame, path: str, duration: str = "duration", files: int = 1, audio_type: str = "audio/wav") -> None:
    """Sample databases whose rows go from short to long, over all files in order."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(SampleSource)
    ordered = df.repartitionByRange(files, duration).sortWithinPartitions(duration)
    ordered.select("audio", "transcript").write.format("sdb").mode("overwrite").option("audio_type", audio_type).save(path)


def write_tar(df: DataFrame, path: str, codec: str = "", mode: str = "overwrite") -> None:
    """One archive a partition; see ``relational.range_shards`` for archives of like size."""
    ship(df.sparkSession)
    df.sparkSession.dataSource.register(TarSource)
    df.select("key", "value").write.format("tar").mode(mode).option("codec", codec).save(path)


#: Pages of a web archive that are handed on at once.
PAGES = 256


def warc_pages(spark: SparkSession, path: str, glob: str = "*.warc*") -> DataFrame:
    """(url, html) of the HTML responses in WARC archives.  A task holds the archives of its split and ``PAGES`` pages of one."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for rows in batched(warc_responses(content.as_py()), PAGES):
                    yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in rows], pa.string()), pa.array([h for _, h in rows], pa.string())], names=["url", "html"])

    content = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("content")
    return content.mapInArrow(run, "url string, html string")


def warc_responses(data: bytes) -> Iterator[tuple[str, str]]:
    """(address, body) of response records with HTML content."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        head = _headers(stream)
        body = stream.read(int(head.get("content-length", "0")))
        if head.get("warc-type") == "response":
            http = io.BytesIO(body)
            http.readline()
            if _headers(http).get("content-type", "").startswith("text/html"):
                yield head.get("warc-target-uri", ""), http.read().decode("utf-8", "replace")


def _headers(stream: io.BytesIO) -> dict[str, str]:
    out = {}
    for line in iter(stream.readline, b""):
        if not line.strip():
            break
        key, _, value = line.decode("utf-8", "replace").partition(":")
        out[key.strip().lower()] = value.strip()
    return out


#: Fixed: recordings of more bytes are not converted.
MOST_BYTES = 250_000_000


def write_scp(audio: DataFrame, done: DataFrame, path: str, command: str = "cat {}", most_bytes: int = MOST_BYTES) -> None:
    """``name command`` lines for recordings without a result yet (both frames have ``name``; audio has ``path``), if they are not too
    large (``bytes``, where audio has it)."""
    small = audio.filter(F.col("bytes") <= most_bytes) if "bytes" in audio.columns else audio
    todo = small.join(done.select("name").distinct(), "name", "left_anti")
    before, after = command.split("{}")
    todo.select(F.concat(F.col("name"), F.lit(" " + before), F.col("path"), F.lit(after)).alias("value")).write.mode("overwrite").text(path)


def write_samples(df: DataFrame, path: str, by: str = "list") -> None:
    """wav_filename, wav_filesize, transcript as CSV with a header, a folder for each list."""
    df.select("wav_filename", "wav_filesize", "transcript", by).write.mode("overwrite").partitionBy(by).option("header", True).csv(path)


def write_dataset(df: DataFrame, path: str) -> None:
    """Headerless path, caption, JSON metadata (from a map column ``fields``)."""
    df.select("path", "caption", F.to_json("fields").alias("metadata")).write.mode("overwrite").option("escape", '"').csv(path)

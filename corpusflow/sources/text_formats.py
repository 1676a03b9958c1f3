"""Readers of line-oriented formats; all give DataFrames with declared columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.functions import text as X
from corpusflow.session import tasks


def catalogue(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """JSON lines of catalogue items; a compressed file is one split, so spread its rows before heavy work."""
    df = spark.read.schema(schemas.CATALOGUE).json(path)
    return df.repartition(partitions) if partitions else df


def declared_json(spark: SparkSession, paths, schema, lines: bool = True) -> DataFrame:
    """JSON of a declared schema from one path or several (their union); nothing is inferred."""
    return spark.read.schema(schema).option("multiLine", not lines).json(paths)


def files(spark: SparkSession, path: str, glob: str | None = None, content: bool = True) -> DataFrame:
    """Binary files (path, modificationTime, length, content); without content no byte is read.

    Folders within are listed by as many tasks as the session shuffles to, not by one for each.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), tasks(spark))))
    try:
        df = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    finally:
        spark.conf.set(name, before)
    return df if content else df.drop("content")


def listed_files(spark: SparkSession, folder: str, names: DataFrame, name: str = "name") -> DataFrame:
    """Binary files whose file name is in ``names``: a semi join with the listing, no driver-side path list."""
    return files(spark, folder).withColumn(name, X.tail(F.col("path"))).join(names.select(name).distinct(), name, "left_semi")


def ctm_words(content: Column, silence: tuple[str, ...] = ("<eps>",)) -> Column:
    """array<struct(utt, channel, start_ms, end_ms, word, conf)> of a CTM text, without silences.

    Six fields a line, times cut to milliseconds; one line that is not so and the whole text is empty.
    """
    lines = F.filter(F.split(F.coalesce(content, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    cells = F.transform(lines, lambda x: F.split(F.trim(x), r"\s+"))
    # through decimals, so that 1.1 s is 1100 ms and not the float below it
    ms = lambda x: F.floor(x.try_cast("decimal(18,6)") * 1000).cast("bigint")
    rows = F.transform(
        cells,
        lambda c: F.struct(
            F.get(c, F.lit(0)).alias("utt"), F.get(c, F.lit(1)).alias("channel"), ms(F.get(c, F.lit(2))).alias("start_ms"),
            ms((F.get(c, F.lit(2)).try_cast("decimal(18,6)") + F.get(c, F.lit(3)).try_cast("decimal(18,6)")).cast("string")).alias("end_ms"),
            F.get(c, F.lit(4)).alias("word"), F.get(c, F.lit(5)).try_cast("double").alias("conf"),
        ),
    )
    good = F.forall(cells, lambda c: (F.size(c) == 6) & F.get(c, F.lit(2)).try_cast("double").isNotNull() & F.get(c, F.lit(3)).try_cast("double").isNotNull() & F.get(c, F.lit(5)).try_cast("double").isNotNull())
    return F.filter(F.when(good, rows).otherwise(F.slice(rows, 1, 0)), lambda r: ~r["word"].isin(*silence))


def table(spark: SparkSession, path, *names: str, rest: bool = False) -> DataFrame:
    """Lines of white-space-separated fields; with ``rest`` the last column holds all that is left of the line."""
    n = len(names)
    cells = F.split(F.trim("value"), r"\s+", n if rest else -1)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(cells.alias("c")).select(*[F.get("c", F.lit(i)).alias(x) for i, x in enumerate(names)])


def segments(spark: SparkSession, path) -> DataFrame:
    """utt, recording, start, end."""
    return table(spark, path, "utt", "recording", "start", "end").select("utt", "recording", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))


def lexicon(spark: SparkSession, path, with_prob: bool = False) -> DataFrame:
    """word, pron[, prob]."""
    if with_prob:
        return table(spark, path, "word", "prob", "pron", rest=True).withColumn("prob", F.col("prob").cast("double"))
    return table(spark, path, "word", "pron", rest=True)


def arpa(spark: SparkSession, path: str) -> DataFrame:
    """(order, gram, logp, backoff) of an ARPA model: lines of numbers and words between its section marks."""
    cells = lambda n: F.substring_index("value", "\t", n)
    last = lambda c: F.substring_index(c, "\t", -1)
    lines = spark.read.text(path).filter(F.contains("value", F.lit("\t")) & cells(1).try_cast("double").isNotNull())
    gram = last(cells(2))
    spaces = F.octet_length(gram) - F.octet_length(F.replace(gram, F.lit(" "), F.lit("")))
    backoff = F.when(cells(3) != cells(2), last(cells(3)).try_cast("double"))
    return lines.select((spaces + 1).alias("order"), gram.alias("gram"), cells(1).cast("double").alias("logp"), F.coalesce(backoff, F.lit(0.0)).alias("backoff"))


def dataset_csv(spark: SparkSession, path) -> DataFrame:
    """Headerless path, caption and optional JSON metadata, the latter as a map too."""
    df = spark.read.schema(schemas.DATASET_CSV).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", True).csv(path)
    return df.withColumn("fields", F.coalesce(X.as_map(F.col("metadata")), F.create_map().cast("map<string,string>")))


def data_book(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Headerless (label, path): paths made absolute, with ``exists`` from a listing of ``folder``."""
    book = spark.read.schema("label string, path string").csv(path).withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), "path"))
    there = files(spark, folder, content=False).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.lit(True).alias("exists"))
    return book.join(there, "path", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def voice_tsv(spark: SparkSession, path) -> DataFrame:
    """Tab-separated with a header; the second and third columns are path and label."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return df.select(F.col(f"`{df.columns[1]}`").alias("path"), F.col(f"`{df.columns[2]}`").alias("label"))


def transcript_lines(spark: SparkSession, path, extension: str = ".flac") -> DataFrame:
    """``id word word ...`` lines of transcript files: audio path beside the file, and label."""
    d = spark.read.text(path).select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "/").alias("dir"), F.split(F.trim("value"), " ", 2).alias("c")).filter(F.size("c") == 2)
    return d.select(F.concat("dir", F.get("c", F.lit(0)), F.lit(extension)).alias("path"), F.get("c", F.lit(1)).alias("label"))


def sidecar_labels(spark: SparkSession, path, drop_words: int = 2) -> DataFrame:
    """One text file beside each recording: its stem, its words after the first ones, and its path."""
    d = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), X.words(F.col("value")).alias("w"))
    return d.select(X.stem(F.col("path")).alias("stem"), F.array_join(F.slice("w", drop_words + 1, F.greatest(F.size("w") - drop_words, F.lit(0))), " ").alias("label"), "path")


def device_transcripts(spark: SparkSession, path, channels: int = 7) -> DataFrame:
    """JSON transcripts with start and end by device: a row a segment, device and channel, times in milliseconds."""
    schema = "session_id string, speaker_id string, words string, start_time map<string,string>, end_time map<string,string>"
    d = spark.read.schema(schema).option("multiLine", True).json(path)
    d = d.select("session_id", "speaker_id", "words", "end_time", F.explode("start_time").alias("device", "start"))
    return d.select("session_id", "speaker_id", "words", "device", F.explode(F.sequence(F.lit(1), F.lit(channels))).alias("channel"), X.clock_ms(F.col("start")).alias("start_ms"), X.clock_ms(F.col("end_time")[F.col("device")]).alias("end_ms"))


def speakers(spark: SparkSession, path) -> DataFrame:
    """``id | gender | subset | hours | name`` with ``;`` comments; a name may hold bars."""
    d = spark.read.text(path).filter(~F.ltrim("value").startswith(";") & F.contains("value", F.lit("|"))).select(F.transform(F.split("value", r"\|"), lambda x: F.trim(x)).alias("c"))
    return d.select(F.get("c", F.lit(0)).alias("speaker"), F.get("c", F.lit(1)).alias("gender"), F.get("c", F.lit(2)).alias("subset"), F.get("c", F.lit(3)).try_cast("double").alias("hours"), F.array_join(F.slice("c", 5, F.greatest(F.size("c") - 4, F.lit(0))), "|").alias("name"))


def samples_csv(spark: SparkSession, path) -> DataFrame:
    """wav_filename, wav_filesize, transcript, the smallest files first."""
    return spark.read.schema("wav_filename string, wav_filesize bigint, transcript string").option("header", True).csv(path).orderBy("wav_filesize", "wav_filename")


def word_vectors(spark: SparkSession, path, most: int) -> DataFrame:
    """The first words of a vector file after its header line (the lines' order is that of the file)."""
    w = spark.read.text(path).select(F.split("value", " ").alias("c")).filter(F.size("c") > 2)
    return w.select(F.get("c", F.lit(0)).alias("word")).limit(most)


def audio_scores(spark: SparkSession, path) -> DataFrame:
    """JSON lines of path, seconds and any class -> score: the classes as a map."""
    d = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m"))
    classes = F.transform_values(F.map_filter("m", lambda k, _: ~k.isin("path", "seconds")), lambda _, v: v.try_cast("double"))
    return d.select(F.col("m")["path"].alias("path"), F.col("m")["seconds"].try_cast("double").alias("seconds"), classes.alias("scores"))

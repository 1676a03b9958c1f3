"""Incremental work: manifests as they arrive, and counts of timed events with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow import schemas
from corpusflow.operators.alignment import trainer_manifest


def arriving(spark: SparkSession, folder: str, schema=schemas.MANIFEST, most_files: int = 1000) -> DataFrame:
    """JSON files of a folder as a stream, ``most_files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).json(folder)


def append_batches(stream: DataFrame, out: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = trainer_manifest) -> StreamingQuery:
    """Each batch changed and written to a folder of its own number, so a batch that is done again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").json(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and kind; rows later than ``late`` are not waited for."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Events by session: one ends when nothing comes for ``gap``."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n"))

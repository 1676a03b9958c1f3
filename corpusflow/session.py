"""Session helpers: the defaults that this engine counts on, and shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}
_shipped: set[str] = set()


def get(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.config(map=DEFAULTS | conf)
    return (builder.master(master) if master else builder).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def tasks(spark: SparkSession) -> int:
    """As many tasks as the session shuffles to: for work that is long beside its rows, which would otherwise be put together to a few tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffled_joins(spark: SparkSession) -> Iterator[None]:
    """Within, only what is marked for broadcast is broadcast: a table that is small as a compressed file can fill the driver as a hash table."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the files of a query's shuffles go with the query; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """A folder that is no longer read, wherever Spark can write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder(spark: SparkSession, kind: str = "queries") -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, under a folder of this machine (local mode only)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: what is used several times is computed once, and outlives lost executors."""
    path = folder(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

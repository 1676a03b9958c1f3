"""Tables between the steps of an iterative operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import ship

#: Rows of one or two numbers that may be broadcast (8 to 16 MB); more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Nodes that ``stars`` holds at once.
HELD_NODES = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of this machine (local mode only)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Written tables cut lineage and survive lost executors; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/corpusflow-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = path
        out._scratch = path
        return out

    def keep_only(self, *tables: DataFrame) -> None:
        """Remove all tables but these."""
        kept = {t._scratch for t in tables}
        for path in set(self.paths.values()) - kept:
            self._remove(path)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._remove(t._scratch)

    def _remove(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows, else as it is."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of one task as (node, smallest node that these edges join it with); after ``HELD_NODES`` nodes begun anew."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = up = parent.setdefault(up, up)
            x = up
        return x

    def told() -> pa.RecordBatch:
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        return pa.RecordBatch.from_pydict({"u": pa.array([x for x, _ in pairs], pa.int64()), "v": pa.array([r for _, r in pairs], pa.int64())})

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD_NODES:
            yield told()
            parent.clear()
    yield told()


def components(edges: DataFrame, scratch: Scratch, rounds: int = 100) -> DataFrame:
    """Connected components of ``edges`` (a, b): (id, component), the component's smallest id.

    Alternating large-star and small-star steps; a step joins each node with its smallest neighbour, so
    no neighbourhood is ever gathered, and rounds grow with the logarithm of the longest chain.  Before the first and after
    each, a task puts its own edges together (``stars``): jobs and plans cost the driver memory, and few rounds are left.
    Neither makes edges more or larger, so a state that a round leaves as it is has one edge for each node, to its component.
    Should ``rounds`` not be enough, that is an error, never an unfinished result.
    """
    ship(scratch.spark)
    pairs = lambda df: df.distinct().mapInArrow(stars, "u long, v long")
    at = scratch.table(pairs(edges.filter("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))))
    seen = None
    for _ in range(rounds):
        mark = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        after = scratch.table(pairs(down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))))
        scratch.drop(at)
        at = after
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return at.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(at.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

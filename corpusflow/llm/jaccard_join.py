"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

The full product would send every n-gram of every document.  Three size-derived bounds keep the same
links with less:

* Equal sets are one class; only its smallest document goes on.
* For similarity t two sets of sizes a and b must share ``need(a, b)`` n-grams, so each must have one of
  its first ``a - ceil(t a) + 1`` n-grams, in any order that is the same for all, in the other's first
  ones.  The order puts n-grams that many documents share last (a bit map of those, counted over all
  documents and all that is stored of their sets, twice a first part; which ones it holds affects speed alone).
* Over these first parts the overlap counts of each pair are added up; a pair is dropped when its count
  plus all that may follow is less than ``need``.

Pairs that are left meet in blocks of bounded size, where the product of whole sets decides exactly.
N-grams that more than ``HOT`` first parts hold give no pairs.  Their documents form groups (by the
document with the largest share of common n-grams); a group is cut by hash into blocks, multiplied each
by itself, and then only documents that are not yet in the component of most of the group meet the whole
group, block by block.  Where these are many, they meet by bands of the sizes they can link with, and only those with enough n-grams that
another document of the group has, too (``_banded``): pages of one template that are no near copies meet no one.
A block returns a spanning forest of its links, never all pairs.

Links cover all pairs of different sets; classes and components are joined back at the end.  Defined
results: a null or empty text, or one without words, has an empty set and is linked with nothing; one
with fewer words than an n-gram has a set of one; texts are hashed whole; a repeated document is in the class of
its twin; an id met with different texts stands for all of them; a row with a null id is linked with nothing, its
component is null, and ``keep_one`` keeps it; an empty table gives no row; extra columns are ignored, by ``keep_one`` kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches, slices
from corpusflow.llm.scratch import Scratch, components, small
from corpusflow.llm.shingles import shingle_set

HOT = 40
#: Size of the bit map of common n-grams: 512 kB, whatever the corpus.
MAP_BITS = 22
#: The part of an n-gram's hash that is counted for that map: shorter keys are less to send, and a clash costs nothing but speed.
COUNTED = (1 << 40) - 1
#: Shingles, with 256 more for each document, that a block holds on average.
BLOCK = 1 << 17
#: Sizes of a band, the largest over the smallest.
BAND = 1.02
#: The same for a block of candidate pairs; it holds no more than this, one pair and one document.
PAIR_BLOCK = 1 << 19


def first_part(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _first(n, percent: int):
    """``first_part`` as a column: n - ceil(percent n / 100) + 1."""
    part = n.cast("long") * F.lit(percent) + 99
    return n.cast("long") + 1 - F.floor((part - F.pmod(part, F.lit(100))) / 100)


def _need(a, b, percent: int):
    """The least overlap of linked sets of sizes a and b, as a column: ceil(percent (a + b) / (100 + percent)), in whole numbers."""
    part, whole = (a.cast("long") + b.cast("long")) * F.lit(percent), F.lit(100 + percent)
    return F.floor((part + whole - 1 - F.pmod(part + whole - 1, whole)) / whole)


def _sizes(n, r, percent: int):
    """The least and the largest size of a set that a set of size n can link with by r shared n-grams, as columns; none if they cross."""
    n, part = n.cast("long"), r.cast("long") * F.lit(100 + percent)
    return n + 1 - _first(n, percent), F.floor((part - F.pmod(part, F.lit(percent))) / percent) - n


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def summaries(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, n, digest of the set, and twice its first part in hash order (as many as it has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw in slices(batch.column(1)):
                sets = [shingle_set(b, words) for b in raw]
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                low = [s[: 2 * first_part(len(s), percent)] for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(raw)), pa.array([len(s) for s in sets], pa.int32()), pa.array(digest, pa.binary()), _lists(low)], names=["id", "n", "digest", "low"])

    return docs.mapInArrow(run, "id long, n int, digest binary, low array<bigint>")


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id and whole set of the documents in ``ids``; no other text is hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(raw)), _lists([shingle_set(b, words) for b in raw])], names=["id", "grams"])

    return docs.join(small(ids), "id", "left_semi").mapInArrow(run, "id long, grams array<bigint>")


def _common(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = grams.view(np.uint64) & np.uint64((1 << MAP_BITS) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def entries(rows: DataFrame, bits: bytes, percent: int, whole: bool) -> DataFrame:
    """(gram, id, n, share, deep) of first parts, common n-grams last.

    ``rows`` holds id, n and the n-grams in hash order, all of them if ``whole``; if not, a document whose
    stored ones don't suffice gives one row with ``deep`` set.  share: of common n-grams among those seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            ids, sizes, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            common = _common(flat, table)
            grams, who = [], []
            share, deep = np.zeros(len(ids), np.float32), np.zeros(len(ids), bool)
            for i, n in enumerate(sizes):
                s, c = flat[ends[i] : ends[i + 1]], common[ends[i] : ends[i + 1]]
                p = first_part(int(n), percent)
                if c.any():
                    share[i] = c.mean()
                    rare = s[~c]
                    if len(rare) < p and len(s) < n and not whole:
                        deep[i], s = True, s[:1]
                    else:
                        s = np.concatenate((rare, s[c]))
                grams.append(s[:p])
                who.append(np.full(len(grams[-1]), i))
            who = np.concatenate(who) if who else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(grams) if grams else np.zeros(0, np.int64), ids[who], sizes[who], share[who], deep[who])], names=["gram", "id", "n", "share", "deep"])

    return rows.select("id", "n", "low").mapInArrow(run, "gram long, id long, n int, share float, deep boolean")


def candidates(sorted_entries: DataFrame, percent: int, hot: int) -> DataFrame:
    """(hot, a, b, na, nb) from entries that lie together by n-gram, the largest share first.

    For an n-gram of up to ``hot`` documents, their pairs of fitting sizes (a < b); for others a row for each
    document a with the first one as b.  An n-gram is read as a stream: at most ``hot`` of its rows are kept.
    """

    def pairs(d: np.ndarray, n: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        out = []
        for k in np.unique(sizes[(sizes > 1) & (sizes <= hot)]):
            rows = starts[sizes == k][:, None] + np.arange(k)
            i, j = np.triu_indices(k, 1)
            out.append(np.stack([rows[:, i].ravel(), rows[:, j].ravel()]))
        if not out:
            return [np.zeros(0, np.int64)] * 4
        i, j = np.concatenate(out, axis=1)
        flip = d[i] > d[j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        fit = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (d[i] != d[j])
        i, j = i[fit], j[fit]
        return [d[i], d[j], n[i], n[j]]

    def batch_of(is_hot: bool, a, b, na, nb) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), is_hot)), *(pa.array(x.astype(np.int64)) for x in (a, b, na, nb))], names=["hot", "a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        leader: tuple | None = None  # (gram, id, n) of the hot n-gram that is being read

        def star(g, d, n):
            return batch_of(True, d, np.full(len(d), leader[1]), n, np.full(len(d), leader[2]))

        for batch in _gathered(batches):
            g, d, n = (np.concatenate((k, c.to_numpy(zero_copy_only=False).astype(np.int64))) for k, c in zip(kept, batch, strict=True))
            if leader is not None:
                k = int(np.searchsorted(g != leader[0], True)) if len(g) and g[0] == leader[0] else 0
                if k:
                    yield star(g[:k], d[:k], n[:k])
                    g, d, n = g[k:], d[k:], n[k:]
                if len(g):
                    leader = None
            if not len(g):
                kept = [np.zeros(0, np.int64)] * 3
                continue
            starts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            sizes = np.diff(np.append(starts, len(g)))
            for s, k in zip(starts[:-1][sizes[:-1] > hot], sizes[:-1][sizes[:-1] > hot], strict=True):
                leader = (g[s], d[s], n[s])
                yield star(g[s : s + k], d[s : s + k], n[s : s + k])
            leader = None
            yield batch_of(False, *pairs(d, n, starts[:-1], sizes[:-1]))
            last = starts[-1]
            kept = [g[last:], d[last:], n[last:]]
            if len(kept[0]) > hot:
                leader = (kept[0][0], kept[1][0], kept[2][0])
                yield star(*kept)
                kept = [np.zeros(0, np.int64)] * 3
        if len(kept[0]):
            yield batch_of(False, *pairs(kept[1], kept[2], np.array([0]), np.array([len(kept[0])])))

    return sorted_entries.select("gram", "id", "n").mapInArrow(run, "hot boolean, a long, b long, na long, nb long")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[list]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= rows:
            yield pa.Table.from_batches(held).columns
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).columns


def linked(sets: list[np.ndarray], queries: int | None, percent: int, slab: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of linked sets, i < j, by a product of the incidence matrix with itself; with ``queries``, i below it."""
    m, rows = len(sets), len(sets) if queries is None else queries
    size = np.array([len(s) for s in sets])
    who = np.repeat(np.arange(m), size)
    grams, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    wide = np.cumsum(count > 1) - 1
    use = count[col] > 1
    who, col = who[use], wide[col[use]]
    over = np.zeros((rows, m), np.float32)
    order = np.argsort(col, kind="stable")
    who, col = who[order], col[order]
    for first in range(0, int(wide[-1]) + 1 if len(wide) else 0, slab):
        a, b = np.searchsorted(col, [first, first + slab])
        x = np.zeros((m, min(slab, int(wide[-1]) + 1 - first)), np.float32)
        x[who[a:b], col[a:b] - first] = 1
        over += x[:rows] @ x.T
    i, j = np.nonzero(over)
    up = j > i
    i, j = i[up], j[up]
    shared = over[i, j].astype(np.int64)  # counts below 2^24 are exact in single precision
    far = 100 * shared >= percent * (size[i] + size[j] - shared)
    return i[far], j[far]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def multiply(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within blocks (block, id, query); if a block has queries, only of these with any."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("query", "descending"), ("id", "ascending")])
        ids, query = table.column("id").to_numpy(), table.column("query").to_numpy()
        lists = table.column("grams").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        i, j = linked(sets, int(query.sum()) or None, percent)
        tree = forest(i, j, len(ids))
        return pa.table({"a": pa.array([ids[x] for x, _ in tree], pa.int64()), "b": pa.array([ids[y] for _, y in tree], pa.int64())})

    return sets.join(small(blocks), "id").select("block", "id", "query", "grams").groupBy("block").applyInArrow(run, "a long, b long")


def _pair_blocks(rare: DataFrame) -> DataFrame:
    """(block, id): every candidate pair (a, b, na, nb) lies in one block; pairs of a neighbourhood lie together.

    A neighbourhood's pairs are cut in order where their shingles fill a block, so that one b with many partners is in as
    many blocks as these need.
    """
    both = rare.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(rare.select(F.col("b").alias("x"), F.col("a").alias("y")))
    label = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label"))
    placed = rare.join(label.select(F.col("x").alias("a"), F.col("label").alias("la")), "a").join(label.select(F.col("x").alias("b"), F.col("label").alias("lb")), "b").select("a", "b", "na", "nb", F.least("la", "lb").alias("place"))
    w = W.partitionBy("place").orderBy("b", "a")
    cost = F.col("na") + 256 + F.when(F.lag("b").over(w) == F.col("b"), 0).otherwise(F.col("nb") + 256)
    placed = placed.withColumn("cost", cost).withColumn("upto", F.sum("cost").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    placed = placed.select("a", "b", F.concat_ws("/", F.lit("p"), "place", F.floor(F.col("upto") / F.lit(PAIR_BLOCK))).alias("block"))
    return placed.select("block", F.col("a").alias("id")).unionByName(placed.select("block", F.col("b").alias("id"))).distinct()


def _cut(group: DataFrame, name: str) -> DataFrame:
    """``group`` (leader, id, n) with a part number: by hash, as many parts as the group has blocks."""
    parts = group.groupBy("leader").agg(F.ceil(F.sum(F.col("n") + 256) / F.lit(BLOCK)).alias(f"{name}_parts"))
    return group.join(small(parts), "leader").withColumn(name, F.pmod(F.xxhash64("id"), F.col(f"{name}_parts")))


def _links(spark, docs: DataFrame, found: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """A spanning set of links (a, b) from candidates and hot groups."""
    rare, hot = found.filter("not hot"), found.filter("hot").select(F.col("b").alias("leader"), F.col("a").alias("id"), F.col("na").alias("n"))
    cut = _cut(hot, "part")
    own = cut.select(F.concat_ws("/", F.lit("g"), "leader", "part").alias("block"), "id")
    lead = cut.select(F.concat_ws("/", F.lit("g"), "leader", "part").alias("block"), F.col("leader").alias("id"))
    blocks = scratch.table(_pair_blocks(rare).unionByName(own.unionByName(lead).distinct()).withColumn("query", F.lit(0)))
    links = scratch.table(multiply(blocks, sets_of(docs, blocks.select("id").distinct(), words), percent))
    if hot.isEmpty():
        return links
    known = scratch.table(components(links, scratch))
    member = hot.join(known, "id", "left").select("leader", "id", "n", F.coalesce("component", "id").alias("c"))
    sizes = member.groupBy("leader", "c").agg(F.count("*").alias("k"))
    main = sizes.groupBy("leader").agg(F.max(F.struct("k", "c")).alias("top")).select("leader", F.col("top.c").alias("main"))
    member = member.join(small(main), "leader")
    apart = scratch.table(_cut(member.filter("c <> main").select("leader", "id", "n"), "row"))
    if apart.isEmpty():
        return links
    keyed = lambda df: df.select(F.col("leader").cast("string").alias("leader"), "id", "n")
    few, many = apart.filter("row_parts = 1"), apart.filter("row_parts > 1")
    grid = _grid(keyed(few), keyed(member.join(small(few.select("leader").distinct()), "leader", "left_semi")))
    if not many.isEmpty():
        grid = grid.unionByName(_grid(*_banded(docs, many, member.join(small(many.select("leader").distinct()), "leader", "left_semi"), words, percent, scratch)))
    grid = scratch.table(grid)
    more = multiply(grid, sets_of(docs, grid.select("id").distinct(), words), percent)
    return links.unionByName(scratch.table(more))


def _grid(asked: DataFrame, every: DataFrame) -> DataFrame:
    """(block, id, query): for each leader all blocks of ``asked`` with all blocks of ``every`` (leader, id, n)."""
    rows, cols = _cut(asked, "row"), _cut(every, "col")
    over = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{name}_parts") - 1)).alias(name)
    queries = rows.join(small(cols.select("leader", "col_parts").distinct()), "leader").select("leader", "row", over("col"), "id", F.lit(1).alias("query"))
    others = cols.join(small(rows.select("leader", "row_parts").distinct()), "leader").select("leader", over("row"), "col", "id", F.lit(0).alias("query"))
    both = queries.unionByName(others).groupBy("leader", "row", "col", "id").agg(F.max("query").alias("query"))
    return both.select(F.concat_ws("/", "leader", "row", "col").alias("block"), "id", "query")


def _banded(docs: DataFrame, apart: DataFrame, member: DataFrame, words: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(asked, every) of groups with many documents apart, by pairs of size bands, without documents that can have no link there.

    An n-gram that no other document of the group has is in no overlap.  So a document with r others can only link with
    one of a band if r is the least overlap with the band's smallest size, or more.  That is at hand before any band is: r and
    the document's size bound the other's, so a document goes to the bands between alone, and to none if there is no such
    size; documents of the group are in the bands for which one is asked.
    """
    band = lambda n: F.floor(F.log(n) / F.log(F.lit(BAND)) + F.lit(1e-9)).cast("int")
    whole = scratch.table(member.select("leader", "id", "n").distinct())
    grams = sets_of(docs, whole.select("id").distinct(), words).join(whole.select("leader", "id"), "id").select("leader", "id", F.explode("grams").alias("gram"))
    alone = grams.groupBy("leader", "gram").agg(F.min("id").alias("id"), F.max("id").alias("last")).filter("id = last").groupBy("leader", "id").agg(F.count("*").alias("alone"))
    sized = whole.join(alone, ["leader", "id"], "left").select("leader", "id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("r"))
    least, most = _sizes(F.col("n"), F.col("r"), percent)
    sized = scratch.table(sized.withColumns({"least": least, "most": most}).filter("least <= most").withColumns({"band": band(F.col("n")), "least": band(F.col("least")), "most": band(F.col("most"))}))
    lows = small(scratch.table(sized.groupBy("leader", F.col("band").alias("other")).agg(F.min("n").alias("low"))))
    fits = F.col("r") >= _need(F.col("n"), F.col("low"), percent)
    key = lambda a, b: F.concat_ws(":", "leader", a, b).alias("leader")
    mine = sized.join(apart.select("leader", "id"), ["leader", "id"], "left_semi").withColumn("other", F.explode(F.sequence("least", "most")))
    asked = scratch.table(mine.join(lows, ["leader", "other"]).filter(fits).select("leader", "band", "other", "id", "n"))
    asks = asked.groupBy("leader", F.col("other").alias("band"), F.col("band").alias("other")).agg(F.min("n").alias("low"))
    every = scratch.table(sized.join(small(scratch.table(asks)), ["leader", "band"]).filter(fits).select(key("other", "band"), "id", "n"))
    return asked.select(key("band", "other"), "id", "n").join(small(every.select("leader").distinct()), "leader", "left_semi"), every


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id: a row for each row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch, docs = Scratch(spark), _texts(docs, key, text)
    known = scratch.table(summaries(docs, words, percent))
    classes = known.filter("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = scratch.table(classes)
    reps = small(classes.select(F.col("rep").alias("id")).distinct())
    chosen = known.join(reps, "id", "left_semi").filter("n > 0")
    counted = chosen.select(F.explode("low").alias("gram")).select(F.col("gram").bitwiseAND(F.lit(COUNTED)).alias("gram")).groupBy("gram").count().filter(F.col("count") > HOT)
    places = counted.select((F.col("gram").bitwiseAND(F.lit((1 << MAP_BITS) - 1))).alias("at")).distinct().toArrow()["at"].to_numpy()
    bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
    first = entries(chosen, bits.tobytes(), percent, whole=False)
    deep_ids = scratch.table(first.filter("deep").select("id").distinct())
    grams = first.filter("not deep")
    if not deep_ids.isEmpty():
        again = sets_of(docs, deep_ids, words).select("id", F.size("grams").alias("n"), F.col("grams").alias("low"), F.xxhash64("grams").alias("same")).dropDuplicates(["id", "same"])
        grams = grams.unionByName(entries(again, bits.tobytes(), percent, whole=True))
    together = grams.repartition("gram").sortWithinPartitions("gram", F.desc("share"), "id")
    pairs = candidates(together, percent, HOT).groupBy("hot", "a", "b").agg(F.count("*").alias("k"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    rest = lambda n: F.col(n).cast("long") - _first(F.col(n), percent)  # noqa: E731  what follows a first part
    enough = F.col("k") + F.greatest(rest("na"), rest("nb")) >= _need(F.col("na"), F.col("nb"), percent)
    found = scratch.table(pairs.filter(F.col("hot") | enough).select("hot", "a", "b", "na", "nb"))
    of = scratch.table(components(_links(spark, docs, found, words, percent, scratch), scratch))
    scratch.keep_only(known, classes, of)
    owner = classes.join(of, classes.rep == of.id, "left").select("digest", F.coalesce("component", "rep").alias("component"))
    alone = known.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    grouped = known.filter("n > 0 and id is not null").join(owner, "digest").select("id", "n", "component")
    return alone.unionByName(grouped).select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, once."""
    found = Scratch(docs.sparkSession).table(jaccard_components(docs, words, percent, key, text))
    out = found.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    kept = docs.join(small(out), key, "left_anti")
    twice = found.groupBy(key).count().filter((F.col("count") > 1) & F.col(key).isNotNull()).select(key)
    if twice.isEmpty():
        return kept
    twice = small(twice)
    return kept.join(twice, key, "left_anti").unionByName(kept.join(twice, key, "left_semi").dropDuplicates([key])).select(*docs.columns)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Size of the shingle set and component of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: On small tables: every pair that shares an n-gram, and all that can be reached from each document.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM w),
d AS (SELECT DISTINCT doc_id, s FROM s WHERE doc_id IS NOT NULL),
g AS (SELECT doc_id, unnest(s) AS g FROM d),
k AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM k JOIN d a ON a.doc_id = x JOIN d b ON b.doc_id = y WHERE 100 * k >= 85 * (len(a.s) + len(b.s) - k)),
twoway AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN twoway ON b = x),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN least ON a IS NOT DISTINCT FROM doc_id"""

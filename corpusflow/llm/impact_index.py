"""Ranked lexical search on a bit-sliced impact index.

Documents lie in blocks of at most ``BLOCK_DOCS``.  For each term of a block the index holds its impacts (whole numbers) as
bitmaps: slice b has a bit for each document whose impact has bit b.  A query adds up the slices of its terms with bitwise
carry arithmetic: a carry-save step folds each term into two sets of slices, one ripple of carries at the end leaves the
scores as slices.  The best k are found going down from the most significant slice: documents with the bit set
are in as a whole while they fit, else only they stay in the race.  A block gives at most k documents for a query, which then
meet the other blocks'.

The index is a table (block, term, bits, slices) in the shared folder, built in one pass over the documents; blocks are
independent, so that a lost one is built or searched again alone.  An index may be built for given terms only, as
``ranked`` does for those of the queries; without a list it holds all terms.

Queries come in batches of a bounded size (``BATCH_ITEMS``, ``BATCH_BYTES``); each batch is one pass over the index.

Defined results: a null text and one without terms hold nothing and count in neither N nor L; repeated documents rank one
by one; repeated queries (id and text) are one, an id with two texts is two; a null doc_id comes before others at equal
score; a query without terms, or whose terms no document holds, has no row; texts are read whole; empty tables give no row;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches, slices
from corpusflow.llm.scratch import Scratch

TOP = 20
BLOCK_DOCS = 4096
#: Queries of a batch, on average, and bytes of their texts.
BATCH_ITEMS = 4096
BATCH_BYTES = 4 << 20
#: The block's doc_ids are kept in the row of this term.
DIRECTORY = -1
NULL_ID = -(1 << 63)
_TERM = np.zeros(256, np.uint8)
_TERM[:] = 32
for _b in (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _TERM[_b] = _b + 32 if 0x41 <= _b < 0x5B else _b
#: Bytes of terms as they are, A-Z lower-cased, and all others as a space.
TABLE = _TERM.tobytes()


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(TABLE).split() if text else []


def term_counts(docs: DataFrame, terms: Sequence[bytes] | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (all terms with repeats), term and tf arrays, a row for each document with a term.

    With ``terms`` they are numbers in that list, and others are only counted in n; without, the terms themselves.
    """
    bounded_batches(docs.sparkSession)
    number = None if terms is None else {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.string() if number is None else pa.int32())
        for batch in batches:
            for start, raw in slices(batch.column(1)):
                ids, size, held, often = [], [], [], []
                for i, b in enumerate(raw):
                    words = terms_of(b)
                    if not words:
                        continue
                    count = Counter(words)
                    asked = sorted(count if number is None else number.keys() & count.keys())
                    ids.append(batch.column(0)[start + i].as_py())
                    size.append(len(words))
                    held.append([t.decode() for t in asked] if number is None else [number[t] for t in asked])
                    often.append([count[t] for t in asked])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(held, kind), pa.array(often, pa.list_(pa.int64()))], names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, f"doc_id long, n long, term array<{'string' if number is None else 'int'}>, tf array<bigint>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 12 m)) with m = 75 + (25 n N) div L, in whole numbers."""
    m = 75 + (25 * n * n_docs) // length
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def sliced(positions: np.ndarray, values: np.ndarray, docs: int) -> tuple[int, np.ndarray]:
    """(slices, bitmaps of 64-bit words) of ``values`` at ``positions`` of a block of ``docs`` documents."""
    bits = int(values.max()).bit_length()
    words = -(-docs // 64)
    out = np.zeros((bits, words), np.uint64)
    row, col = np.nonzero((values[None] >> np.arange(bits)[:, None]) & 1)
    at = positions[col]
    np.bitwise_or.at(out, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return bits, out


def build(counts: DataFrame, weights: dict, n_docs: int, length: int) -> DataFrame:
    """The index (block, term, bits, slices) of ``term_counts``; of numbered terms only those with a weight.

    A block's documents are in ascending order of doc_id, so that the lowest positions come first among equals.
    """

    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("doc_id").fill_null(NULL_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lists = rows.column("term").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        size = np.diff(lists.offsets.to_numpy())
        who, term = np.repeat(np.arange(len(ids)), size), lists.flatten().to_numpy(zero_copy_only=False)
        tf = rows.column("tf").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        names, which = np.unique(term, return_inverse=True)
        w = np.array([max(0, weights[t]) for t in names.tolist()], np.int64)
        value = impacts(w[which], tf, rows.column("n").to_numpy()[who], n_docs, length) if len(term) else np.zeros(0, np.int64)
        order_t = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[order_t], np.arange(len(names) + 1))
        made = [(DIRECTORY, 0, ids[order].tobytes())]
        for k, t in enumerate(names.tolist()):
            own = order_t[ends[k] : ends[k + 1]]
            own = own[value[own] > 0]
            if len(own):
                bits, out = sliced(place[who[own]], value[own], len(ids))
                made.append((t, bits, out.tobytes()))
        t, bits, data = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([number] * len(made), pa.int64()), pa.array(t, pa.int32()), pa.array(bits, pa.int32()), pa.array(data, pa.binary())], names=["block", "term", "bits", "slices"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for s in range(0, len(batch), BLOCK_DOCS):
                part = batch.slice(s, BLOCK_DOCS)
                if rows + len(part) > BLOCK_DOCS:
                    yield block(number, pa.Table.from_batches(held))
                    number, held, rows = number + 1, [], 0
                held.append(part)
                rows += len(part)
        if rows:
            yield block(number, pa.Table.from_batches(held))

    return counts.mapInArrow(run, "block long, term int, bits int, slices binary")


def added(parts: list[tuple[np.ndarray, int]], words: int) -> np.ndarray:
    """The sum of sliced numbers, each shifted up by so many slices: carry-save steps, and one ripple at the end."""
    height = sum((1 << len(x)) - 1 << shift for x, shift in parts).bit_length()
    total, carry = np.zeros((height, words), np.uint64), np.zeros((height, words), np.uint64)
    for x, shift in parts:
        own = slice(shift, shift + len(x))
        both = total & carry  # carries go one slice up
        half = total ^ carry
        both[own] |= half[own] & x
        half[own] ^= x
        total = half
        carry[0] = 0
        carry[1:] = both[:-1]
    up = np.zeros(words, np.uint64)
    for r in range(height):
        a, b = total[r], carry[r]
        half, both = a ^ b, a & b
        total[r] = half ^ up
        up = both | (half & up)
    return total


def best(total: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the k highest scores above 0, the lowest positions among equals; in order of position."""
    inside, race, n = np.zeros(total.shape[1], np.uint64), np.bitwise_or.reduce(total, axis=0), 0
    for r in range(len(total) - 1, -1, -1):
        hit = race & total[r]
        more = int(np.bitwise_count(hit).sum())
        if n + more > k:
            race = hit
        else:
            inside |= hit
            n += more
            race &= ~total[r]
            if n == k:
                break
    at = np.flatnonzero(np.unpackbits(inside.view(np.uint8), bitorder="little"))
    if n < k:  # equals
        at = np.sort(np.concatenate((at, np.flatnonzero(np.unpackbits(race.view(np.uint8), bitorder="little"))[: k - n])))
    bits = (total[:, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
    return at, (bits << np.arange(len(total), dtype=np.uint64)[:, None]).sum(axis=0).astype(np.int64)


def search(index: DataFrame, queries: list[tuple[int, list[int]]], top: int = TOP) -> DataFrame:
    """(query, doc_id, score): the best ``top`` documents of each block for each query (its number, and its terms with repeats)."""
    wanted = [(q, sorted(Counter(terms).items())) for q, terms in queries]

    def run(rows: pa.Table) -> pa.Table:
        term, bits, data = (rows.column(c).to_pylist() for c in ("term", "bits", "slices"))
        held = dict(zip(term, zip(bits, data, strict=True), strict=True))
        ids = np.frombuffer(held.pop(DIRECTORY)[1], np.int64)
        words = -(-len(ids) // 64)
        known = {t: np.frombuffer(x, np.uint64).reshape(b, words) for t, (b, x) in held.items()}
        who, doc, score = [], [], []
        for q, asked in wanted:
            parts = [(known[t], s) for t, often in asked if t in known for s in range(often.bit_length()) if often >> s & 1]
            if parts:
                at, found = best(added(parts, words), top)
                who.append(np.full(len(at), q))
                doc.append(ids[at])
                score.append(found)
        whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, doc, score)]
        return pa.table({"query": pa.array(whole[0], pa.int64()), "doc_id": pa.array(whole[1], pa.int64(), mask=whole[1] == NULL_ID), "score": pa.array(whole[2], pa.int64())})

    return index.groupBy("block").applyInArrow(run, "query long, doc_id long, score long")


def build_index(docs: DataFrame, terms: Sequence[bytes], scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index of ``terms`` over all documents; corpus counts (N, L, df) are of all documents."""
    counts = scratch.table(term_counts(docs, terms, key, text))
    n_docs, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r.term: r.n for r in counts.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}  # as many as there are asked terms
    index = scratch.table(build(counts, {t: weight(n_docs, n) for t, n in df.items()}, n_docs, max(1, length)))
    scratch.drop(counts)
    return index


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, item: str = "item_id", key: str = "doc_id", text: str = "text") -> DataFrame:
    """item, rank, doc_id, score: each item's ``top`` documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    asked = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).filter("text is not null").distinct()
    asked = asked.withColumn("query", F.xxhash64("item", "text"))
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    batches = max(1, -(-n // BATCH_ITEMS), -(-size // BATCH_BYTES))
    asked = scratch.table(asked.withColumn("batch", F.pmod(F.col("query"), F.lit(batches))))
    found = None
    for batch in range(batches):
        rows = asked.filter(F.col("batch") == batch).select("query", "text").collect()
        words = {r.query: terms_of(r.text.encode()) for r in rows}
        terms = sorted(set().union(*words.values()))
        number = {t: i for i, t in enumerate(terms)}
        index = build_index(docs, terms, scratch, key, text)
        made = scratch.table(search(index, sorted((q, [number[t] for t in w]) for q, w in words.items()), top))
        scratch.drop(index)
        found = made if found is None else found.unionByName(made)
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best_of = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best_of.join(asked.select("query", "item"), "query").select(F.col("item").alias(item), "rank", "doc_id", "score")


def op12_impact_search(spark, sf_dir: str) -> DataFrame:
    """All documents, ranked for each benchmark item."""
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM w WHERE len(w) > 0),
c AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM d),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY t, big_n),
i AS (SELECT item_id, k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT item_id, text, row_number() OVER () AS k FROM (SELECT DISTINCT item_id, text FROM benchmark))),
q AS (SELECT item_id, k, t, count(*) AS often FROM i GROUP BY ALL),
s AS (SELECT item_id, k, r, sum(often * f.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l))))::BIGINT AS score
  FROM q JOIN f USING (t) JOIN p USING (t) JOIN d USING (r), c GROUP BY ALL),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id, k ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20"""

"""A Kneser-Ney model of order 3 of texts of any size, written as ARPA lines on little disk.

The same model as ``lm.kn_model`` of order 3, whose rows of strings take several times the texts when they are shuffled. Here
tasks hand on blocks: a sorted list of words and whole numbers, compressed together. A trigram goes to the bucket of its middle
word, where the sums over its history and the distinct words before its end are at hand; a bigram goes to that of its second word.
Tables that are no longer read are removed, and shuffles with the job that made them.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import words
from corpusflow.operators.lm import arpa_lines
from corpusflow.session import folder, freed_shuffles, remove, ship, tasks

#: Tokens that a task counts before it hands them on; characters of text in a bucket; lines of a batch; one in so many texts is looked at for frequent words.
BLOCK, CHARS, LINES, LOOKED_AT = 1 << 21, 12_000_000, 50_000, 50
#: What a bucket of trigrams keeps; bigrams by their count and their history's; bigrams as histories.
KEPT, ENDS, HISTORIES = 0, 1, 2
BLOCKS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("part", pa.int32()), ("block", pa.binary()), *[(x, pa.int64()) for x in ("n1", "n2", "m1", "m2", "m")]])
WORDS = pa.schema([("word", pa.string()), *[(x, pa.int64()) for x in ("before", "kept", "all", "mass")]])
LINE = pa.schema([("value", pa.string())])
#: Of the bytes of a word, for its hash.
WEIGHTS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))
SQL_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {SQL_TYPES[f.type]}" for f in schema)


# Blocks. Columns of words hold places in the list, from 1; 0 is no word.


def packed(known: pa.Array, ids: list[np.ndarray], numbers: list[np.ndarray]) -> bytes:
    """The columns and those of the words that they name."""
    if len(known) < 64 * sum(map(len, ids)):
        there = np.zeros(len(known) + 1, bool)
        for x in ids:
            there[x] = True
        there[0] = False
        place, used = np.cumsum(there), np.flatnonzero(there)
    else:
        used = np.unique(np.concatenate([np.zeros(1, np.int64), *ids]))[1:]
        place = None
    local = [place[x] if place is not None else np.searchsorted(used, x, "right") for x in ids]
    held = known.take(pa.array(used - 1))
    ends = np.frombuffer(held.buffers()[1], np.int32, len(held) + 1, held.offset * 4) if len(held) else np.zeros(1, np.int32)
    data = np.frombuffer(held.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    head, body = [len(ids)], []
    for x in (np.diff(ends), data, *local, *numbers):
        rising = len(x) > 1 and bool((x[1:] >= x[:-1]).all())
        x = np.diff(x, prepend=x.dtype.type(0)) if rising else x
        width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << (8 * w - (w == 8)))
        head += [len(x), width, int(rising)]
        body.append(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())  # like bytes side by side
    raw = b"".join([np.array([len(head), *head], "<i8").tobytes(), *body])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def unpacked(block: bytes) -> tuple[pa.Array, list[np.ndarray]]:
    raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", n, 8), 8 * (n + 1), []
    for count, width, rising in head[1:].reshape(-1, 3).tolist():
        x = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count).T.copy().view(f"<u{width}").reshape(-1).astype(np.int64)
        at += count * width
        out.append(np.cumsum(x) if rising else x)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(out[0])]).astype(np.int32)
    return pa.StringArray.from_buffers(len(out[0]), pa.py_buffer(ends), pa.py_buffer(out[1].astype(np.uint8))), out[2:]


def united(lists: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """All words in order, and where those of each list stand (with 0 for no word)."""
    every = pa.chunked_array(lists, pa.string()).combine_chunks()
    every = (every.combine_chunks() if isinstance(every, pa.ChunkedArray) else every).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    places = rank[every.indices.to_numpy()]
    cuts = np.cumsum([len(x) for x in lists])[:-1]
    return every.dictionary.take(pa.array(order)), [np.concatenate([np.zeros(1, np.int64), x]) for x in np.split(places, cuts)]


def hashes(known: pa.Array) -> np.ndarray:
    """A number from 0 for each word, by its bytes alone."""
    if not len(known):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(known.buffers()[1], np.int32, len(known) + 1, known.offset * 4).astype(np.int64)
    data = np.frombuffer(known.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    at = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
    h = np.add.reduceat((data + np.uint64(1)) * WEIGHTS[at % len(WEIGHTS)], ends[:-1] - ends[0])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(24)).astype(np.int64)


def keyed(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """A number for each row, in the order of the columns."""
    key, size = columns[0], sizes[0]
    for x, n in zip(columns[1:], sizes[1:], strict=True):
        if size * n >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key, size = key * n + x, size * n
    return key


def added(columns: list[np.ndarray], counts: list[np.ndarray], size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of places up to ``size`` in order, with sums of their counts."""
    if not len(columns[0]):
        return columns, counts
    key = keyed(columns, [size + 1] * len(columns))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return [x[order[first]] for x in columns], [np.add.reduceat(x[order], first) for x in counts]


@dataclass
class Places:
    """Where n-grams go: to a bucket by their second word; a frequent word has a bucket of its own, in parts by the first word."""

    buckets: int
    frequent: dict[str, int]

    def of_words(self, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word (and of no word, at 0): hash, bucket, parts."""
        h = hashes(known)
        bucket, parts = h % self.buckets, np.ones(len(h), np.int64)
        for i, at in enumerate(pc.index_in(pa.array(list(self.frequent), pa.string()), value_set=known).to_pylist()):
            if at is not None:
                bucket[at], parts[at] = self.buckets + i, list(self.frequent.values())[i]
        return tuple(np.concatenate([np.zeros(1, np.int64), x]) for x in (h, bucket, parts))

    def dealt(self, kind: int, known: pa.Array, of: tuple[np.ndarray, ...], ids: list[np.ndarray], second: int, numbers: list[np.ndarray]) -> Iterator[dict]:
        """The rows as blocks; the first word is in the column before ``second``, if there is one."""
        h, bucket, parts = of
        b = ids[second]
        part = (h[ids[second - 1]] >> 8) % parts[b] if second else np.zeros(len(b), np.int64)
        first = np.concatenate([np.arange(self.buckets), self.buckets + np.cumsum([0, *self.frequent.values()])])
        place = first[bucket[b]] + part
        order = np.argsort(place.astype(np.uint16) if first[-1] < 1 << 16 else place, kind="stable")  # short numbers are sorted by their digits
        cuts = np.flatnonzero(np.diff(place[order], prepend=-1))
        for x in np.split(order, cuts[1:]) if len(order) else ():
            yield {"kind": kind, "bucket": int(bucket[b[x[0]]]), "part": int(part[x[0]]), "block": packed(known, [c[x] for c in ids], [c[x] for c in numbers])}


def batched(rows: Iterable[dict], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append({f.name: r.get(f.name, 0) for f in BLOCKS})
        size += len(r["block"]) + 200
        if size > most:
            yield pa.RecordBatch.from_pylist(held, BLOCKS)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, BLOCKS)


def read(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {f.name: batch.column(j)[i].as_py() for j, f in enumerate(batch.schema)}


def by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, Iterator[dict]]]]]:
    """Buckets, their parts and these's blocks, from rows in that order."""
    for bucket, rows in groupby(read(batches), lambda r: r["bucket"]):
        yield bucket, ((part, own) for part, own in groupby(rows, lambda r: r["part"]))


# The steps.


def split(texts: pa.Array) -> pa.ListArray:
    """As ``functions.text.words``, of texts in lower case with sentence marks at their ends (so none is blank, and none begins or ends with white space)."""
    return pc.ascii_split_whitespace(texts)


def trigrams_of(batches: Iterator[pa.RecordBatch], places: Places) -> Iterator[dict]:
    """Blocks of counted (word or none, word, word) of texts with sentence marks; none stands before the first word."""
    for batch in batches:
        lines = split(batch.column(0))
        ends = lines.offsets.to_numpy().astype(np.int64)
        at = 0
        while at < len(lines):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
            own = lines.slice(at, to - at).flatten().dictionary_encode()
            known, (rank,) = united([own.dictionary])
            t = rank[own.indices.to_numpy().astype(np.int64) + 1]
            starts = ends[at:to] - ends[at]
            before = np.concatenate([np.zeros(1, np.int64), t[:-1]])
            before[starts] = 0
            inner = np.ones(len(t), bool)
            inner[ends[at + 1 : to + 1] - ends[at] - 1] = False  # nothing follows the last word
            b = np.flatnonzero(inner)
            (b, a, c), (n,) = added([t[b], before[b], t[b + 1]], [np.ones(len(b), np.int64)], len(known))
            yield from places.dealt(KEPT, known, places.of_words(known), [a, b, c], 1, [n])
            at = to


def counted(batches: Iterator[pa.RecordBatch], places: Places) -> Iterator[dict]:
    """A bucket's trigrams, and its bigrams for the buckets of their second words.

    Kept: (a, b, c) with counts, and for each history a sum of what the bigrams (b, c) count and b's sum of these. A bigram
    counts distinct words before it; if b has none, its own count.
    """
    for bucket, parts in by_part(batches):
        with tempfile.TemporaryFile() as spool:
            ends, mine = [], []
            for part, blocks in parts:
                known, (a, b, c), n = _summed(blocks, 3)
                (fb, fc), (k, m) = added([b, c], [(a > 0).astype(np.int64), n], len(known))
                ends.append((known, fb, fc, k, m))
                block = packed(known, [a, b, c], [n])
                mine.append((part, spool.tell(), len(block)))
                spool.write(block)
            known, ranks = united([x[0] for x in ends])
            (fb, fc), (k, m) = added([np.concatenate([r[x[i]] for r, x in zip(ranks, ends, strict=True)]) for i in (1, 2)], [np.concatenate([x[i] for x in ends]) for i in (3, 4)], len(known))
            del ends
            kinds, every = sums(fb, k, len(known)), sums(fb, m, len(known))
            mass = np.where(kinds > 0, kinds, every)
            own = np.where(kinds[fb] > 0, k, m)
            of = places.of_words(known)
            keys = keyed([fb, fc], [len(known) + 1] * 2)
            stats = {"m1": int((m == 1).sum()), "m2": int((m == 2).sum()), "m": len(m)}
            for part, at, size in mine:
                spool.seek(at)
                listed, (a, b, c, n) = unpacked(spool.read(size))
                real = a > 0
                a, b, c, n = a[real], b[real], c[real], n[real]
                to = np.concatenate([np.zeros(1, np.int64), pc.index_in(listed, value_set=known).fill_null(-1).to_numpy().astype(np.int64) + 1])
                x = own[np.searchsorted(keys, keyed([to[b], to[c]], [len(known) + 1] * 2))]
                first = _first(a, b)
                total = lambda v, first=first: np.add.reduceat(v, first) if len(first) else v
                ha, hb, kept, every_n, seen, whole = a[first], b[first], total(np.ones_like(n)), total(n), total(x), mass[to[b[first]]]
                yield {"kind": KEPT, "bucket": bucket, "part": part, "block": packed(listed, [a, b, c], [n, seen, whole]), "n1": int((n == 1).sum()), "n2": int((n == 2).sum()), **stats}
                stats = {}
                yield from places.dealt(HISTORIES, listed, places.of_words(listed), [ha, hb], 1, [kept, every_n, seen, whole])
            yield from places.dealt(ENDS, known, of, [fb, fc], 1, [own, mass[fb]])
            held = sums(fb, own > 0, len(known))
            w = np.flatnonzero(mass)
            yield from places.dealt(HISTORIES, known, of, [np.zeros_like(w), w], 1, [held[w], np.zeros_like(w), np.zeros_like(w), mass[w]])


def sums(at: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    """By place up to ``size``; exact below 2**53."""
    return np.bincount(at, numbers, size + 1).astype(np.int64)


def _first(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)


def _together(blocks: Iterable[dict], ids: dict[int, int]) -> tuple[pa.Array, dict[int, list[np.ndarray]]]:
    """Words and, by kind, columns of all blocks; ids: by kind, how many columns name words."""
    got = [(r["kind"], *unpacked(r["block"])) for r in blocks]
    known, ranks = united([x[1] for x in got])
    out: dict[int, list[list[np.ndarray]]] = {}
    for (kind, _, columns), rank in zip(got, ranks, strict=True):
        out.setdefault(kind, []).append([rank[x] if i < ids[kind] else x for i, x in enumerate(columns)])
    return known, {k: [np.concatenate(x) for x in zip(*v, strict=True)] for k, v in out.items()}


def _summed(blocks: Iterable[dict], ids: int) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    known, columns = _together(blocks, {KEPT: ids})
    a, b, c, n = columns[KEPT]
    (b, a, c), (n,) = added([b, a, c], [n], len(known))
    return known, [a, b, c], n


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Bigrams (b, c) by their second word, with what is known of them as ends and as histories; m is how many there are."""
    for bucket, parts in by_part(batches):
        for part, blocks in parts:
            known, columns = _together(blocks, {ENDS: 2, HISTORIES: 2})
            none = [np.zeros(0, np.int64)] * 6
            b, c, own, mass = columns.get(ENDS, none[:4])
            order = np.argsort(keyed([c, b], [len(known) + 1] * 2))
            b, c, own, mass = b[order], c[order], own[order], mass[order]
            ha, hb, *more = columns.get(HISTORIES, none)
            at = np.searchsorted(keyed([c, b], [len(known) + 1] * 2), keyed([hb, ha], [len(known) + 1] * 2)[ha > 0])
            found = []
            for x in more:
                found.append(np.zeros(len(b), np.int64))
                found[-1][at] = x[ha > 0]
            w = hb[ha == 0]
            yield {"kind": KEPT, "bucket": bucket, "part": part, "block": packed(known, [b, c, w], [own, mass, *found, more[0][ha == 0], more[3][ha == 0]]), "m": len(b)}


def word_sums(batches: Iterator[pa.RecordBatch], places: Places, frequent: dict[int, int]) -> Iterator[dict]:
    """Blocks of words: bigrams that end in them, what is known of them as histories, and the sum of ``before`` over the words after them."""
    for r in read(batches):
        known, (b, c, w, *numbers) = unpacked(r["block"])
        before = np.bincount(c, minlength=len(known) + 1)
        every = np.full(len(known) + 1, frequent[r["bucket"]]) if r["bucket"] in frequent else before
        out = [before, *(np.zeros(len(known) + 1, np.int64) for _ in range(3))]
        out[1][w], out[2][w] = numbers[-2:]
        out[3] = sums(b, every[c], len(known))
        own = np.flatnonzero(sum(out) > 0)
        yield from places.dealt(KEPT, known, places.of_words(known), [own], 0, [x[own] for x in out])


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, parts in by_part(batches):
        for _, blocks in parts:
            known, columns = _together(blocks, {KEPT: 1})
            (w,), sums = added(columns[KEPT][:1], columns[KEPT][1:], len(known))
            yield pa.RecordBatch.from_arrays([known.take(pa.array(w - 1)), *map(pa.array, sums)], schema=WORDS)


def numbers_told(x: np.ndarray) -> pa.Array:
    d = pa.array(x).dictionary_encode()
    return pa.array(["%.7f" % v for v in d.dictionary.to_pylist()], pa.string()).take(d.indices)


def told(lines: pa.Array) -> pa.RecordBatch:
    """One row of many lines, which a text file does not tell from rows of one."""
    every = pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines)
    return pa.RecordBatch.from_arrays([pc.binary_join(every, "\n")], schema=LINE)


def logs(f: np.ndarray) -> np.ndarray:
    return np.where(f > 0, np.log10(np.where(f > 0, f, 1.0)), -99.0)


@dataclass
class Discounts:
    """Of bigrams and trigrams; raised: factors of words that every other word was seen after."""

    two: float
    three: float
    raised: dict[str, float]

    def factors(self, known: pa.Array) -> np.ndarray:
        out = np.ones(len(known) + 1)
        for at, x in zip(pc.index_in(pa.array(list(self.raised), pa.string()), value_set=known).to_pylist(), self.raised.values(), strict=True):
            if at is not None:
                out[at + 1] = x
        return out

    def lower(self, kept: np.ndarray, seen: np.ndarray, mass: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """What bigrams leave after a history's words."""
        return 1 - factor * (seen - kept * self.two) / mass


def trigram_lines(batches: Iterator[pa.RecordBatch], d: Discounts) -> Iterator[pa.RecordBatch]:
    for r in read(batches):
        known, (a, b, c, n, seen, mass) = unpacked(r["block"])
        if not len(a):
            continue
        first = _first(a, b)
        every = np.add.reduceat(n, first)
        kept = np.diff(first, append=len(a))
        f = np.maximum(0.0, n - d.three) / np.repeat(every, kept)
        whole = np.add.reduceat(f, first)
        raised = (d.lower(kept, seen, mass, d.factors(known)[b[first]]) <= 1e-12) & (whole > 0)
        logp = logs(f / np.repeat(np.where(raised, whole, 1.0), kept))
        for i in range(0, len(a), LINES):
            x = slice(i, i + LINES)
            gram = pc.binary_join_element_wise(*(known.take(pa.array(v[x] - 1)) for v in (a, b, c)), " ")
            yield told(pc.binary_join_element_wise(numbers_told(logp[x]), gram, "\t"))


def bigram_lines(batches: Iterator[pa.RecordBatch], d: Discounts) -> Iterator[pa.RecordBatch]:
    for r in read(batches):
        known, (b, c, _, own, mass, kept, every, seen, whole, *_) = unpacked(r["block"])
        factor = d.factors(known)
        logp = logs(factor[b] * np.maximum(0.0, own - d.two) / mass)
        upper = kept * d.three / np.maximum(every, 1)
        lower = d.lower(kept, seen, np.maximum(whole, 1), factor[c])
        there = (kept > 0) & (upper > 1e-12) & (lower > 1e-12)
        back = np.log10(np.where(there, upper, 1.0) / np.where(there, lower, 1.0))
        for i in range(0, len(b), LINES):
            x = slice(i, i + LINES)
            gram = pc.binary_join_element_wise(*(known.take(pa.array(v[x] - 1)) for v in (b, c)), " ")
            tail = pc.if_else(pa.array(there[x]), pc.binary_join_element_wise("\t", numbers_told(back[x]), ""), "")
            yield told(pc.binary_join_element_wise(numbers_told(logp[x]), pc.binary_join_element_wise(gram, tail, ""), "\t"))


def places_of(docs: DataFrame, text: str) -> Places:
    """Buckets by the length of all texts; frequent words from some of the texts (they decide where n-grams are counted, not what is counted)."""
    looked_at = F.pmod(F.xxhash64(text), F.lit(LOOKED_AT)) == 0
    said = F.concat(F.array(F.lit("<s>")), words(F.lower(text)), F.array(F.lit("</s>")))
    chars, total = docs.agg(F.sum(F.length(text)), F.sum(F.when(looked_at, F.size(said)))).first()
    need = math.ceil((chars or 0) / CHARS)
    frequent: dict[str, int] = {}
    if need > 4 and total:
        counts = docs.filter(looked_at).select(F.explode(said).alias("word")).groupBy("word").count()
        share = F.col("count") / F.lit(total)
        rows = counts.filter((F.col("count") >= 30) & (share * need > 1.5)).select("word", share.alias("share")).collect()
        frequent = {r.word: math.ceil(r.share * need) for r in rows}
    return Places(max(need, tasks(docs.sparkSession)), frequent)


def write_arpa(docs: DataFrame, text: str, path: str) -> None:
    """The lines of ``lm.arpa_lines(lm.kn_model(docs, text, 3))`` as compressed text files in ``path``."""
    spark = docs.sparkSession
    ship(spark)
    marked = F.concat(F.lit("<s> "), F.coalesce(F.lower(text), F.lit("")), F.lit(" </s>"))
    lines, root, sql = docs.select(marked.alias("line")), folder(spark, "trigrams"), _sql(BLOCKS)

    def met_by(d: DataFrame) -> DataFrame:
        n = tasks(spark)
        return d.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket", "part")

    def put(d: DataFrame, name: str) -> DataFrame:
        d.write.option("compression", "zstd").partitionBy("own").parquet(f"{root}/{name}")
        return spark.read.schema(f"{sql}, own boolean").parquet(f"{root}/{name}")

    mapped = lambda d, f: d.mapInArrow(lambda batches: batched(f(batches)), sql)
    own = (F.col("kind") == KEPT).alias("own")
    try:
        with freed_shuffles(spark):
            places = places_of(docs, text)
            first = met_by(mapped(lines, lambda x: trigrams_of(x, places)))
            first = put(mapped(first, lambda x: counted(x, places)).select("*", own), "trigrams")
            n1, n2, m1, m2, m = first.filter("own").agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("n1", "n2", "m1", "m2", "m")]).first()
            discount = lambda x, y: x / (x + 2 * y) if x else 0.0
            second = put(mapped(met_by(first.filter("NOT own").drop("own")), met).select("*", own), "bigrams")
            remove(spark, f"{root}/trigrams/own=false")
            frequent = {r.bucket: r.m for r in second.filter(F.col("bucket") >= places.buckets).groupBy("bucket").agg(F.sum("m").alias("m")).collect()}
            third = met_by(mapped(second.drop("own"), lambda x: word_sums(x, places, frequent))).mapInArrow(words_of, _sql(WORDS))
            third.write.option("compression", "zstd").parquet(f"{root}/words")
            third = spark.read.schema(_sql(WORDS)).parquet(f"{root}/words")
            two = discount(m1, m2)
            upper, lower = F.col("kept") * two / F.nullif("all", F.lit(0)), 1 - F.col("mass") / m
            # a word that every other one was seen after: no more of them than the root of the number of bigrams
            raised = third.filter((F.col("all") > 0) & (lower <= 1e-12)).select("word", (1 - upper).alias("sum")).collect() if m else []
            d = Discounts(two, discount(n1, n2), {r.word: 1 / r.sum for r in raised if r.sum > 0})
            f = F.col("before") / m
            one = third.select(F.col("word").alias("gram"), F.when(f > 0, F.log10(f)).otherwise(-99.0).alias("logp"), F.when((upper > 1e-12) & (lower > 1e-12), F.log10(upper / lower)).alias("backoff"))
            add = lambda x: x.write.mode("append").option("compression", "gzip").text(path)
            if m:
                add(arpa_lines(one))
            add(first.filter("own").drop("own").mapInArrow(lambda x: trigram_lines(x, d), "value string"))
            remove(spark, f"{root}/trigrams")
            add(second.drop("own").mapInArrow(lambda x: bigram_lines(x, d), "value string"))
    finally:
        remove(spark, root)

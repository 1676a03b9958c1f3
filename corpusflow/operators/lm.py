"""Subword learning and sentence probabilities."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions.text import words
from corpusflow.session import folder, ship, written

END = "</w>"
#: Codes of symbols: 0 between words, then characters, characters at the end of a word (from ENDED), merged symbols (from MADE).
ENDED, MADE = 0x110001, 0x220001
#: Characters of words in a block; merges that rounds apply anew before the blocks are rewritten; pairs that reach the driver.
BLOCK, KEPT_STEPS, RANKED = 500_000, 24, 1000
#: N-grams that texts ask for and that may be sent to every worker.
ASKED = 500_000


def learn_merges(counts: Mapping[str, int], merges: int, least: int = 2) -> list[tuple[str, str]]:
    """The most frequent neighbouring symbols, again and again; of equals the larger pair by text.

    Words end in ``</w>``. Counts of pairs are kept up to date word by word, so a step touches only words that hold the pair.
    """
    split = {w: (*w[:-1], w[-1] + END) for w in counts if w}
    pairs: Counter = Counter()
    holders: dict[tuple[str, str], set[str]] = defaultdict(set)
    for w, s in split.items():
        for p in zip(s, s[1:], strict=False):
            pairs[p] += counts[w]
            holders[p].add(w)
    out = []
    while len(out) < merges and pairs:
        best = max(pairs, key=lambda p: (pairs[p], p))
        if pairs[best] < least:
            break
        out.append(best)
        for w in list(holders[best]):
            old, new = split[w], joined(split[w], best)
            for p in zip(old, old[1:], strict=False):
                pairs[p] -= counts[w]
                holders[p].discard(w)
                if not pairs[p]:
                    del pairs[p]
            for p in zip(new, new[1:], strict=False):
                pairs[p] += counts[w]
                holders[p].add(w)
            split[w] = new
        pairs.pop(best, None)
    return out


def joined(symbols: Sequence[str], pair: tuple[str, str]) -> tuple[str, ...]:
    """All occurrences of a pair put together, from the left."""
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
            out.append(symbols[i] + symbols[i + 1])
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return tuple(out)


def subwords(word: str, ranks: Mapping[tuple[str, str], int], kept: Iterable[str] = ()) -> tuple[str, ...]:
    """A word's subwords by the merges' ranks; words in ``kept`` stay whole."""
    if not word or word in kept:
        return (word,) if word else ()
    symbols: tuple[str, ...] = (*word[:-1], word[-1] + END)
    while len(symbols) > 1:
        known = [p for p in zip(symbols, symbols[1:], strict=False) if p in ranks]
        if not known:
            break
        symbols = joined(symbols, min(known, key=ranks.__getitem__))
    last = symbols[-1].removesuffix(END)
    return (*symbols[:-1], last) if last else symbols[:-1]


def encoded(texts: Sequence[str]) -> np.ndarray:
    """Words as codes, a zero after each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    codes = np.zeros(int(ends[-1]) + 1, np.int32)
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int32) + 1
    codes[ends - 1] += ENDED - 1
    return codes


def put_together(codes: np.ndarray, first: int, second: int, new: int) -> np.ndarray:
    """All occurrences of a pair as the new code, from the left."""
    at = np.flatnonzero((codes[:-1] == first) & (codes[1:] == second))
    if not len(at):
        return codes
    begins = np.concatenate(([True], np.diff(at) != 1))
    at = at[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]
    codes = codes.copy()
    codes[at] = new
    return np.delete(codes, at + 1)


def pair_counts(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring codes as first << 32 | second, and how often they occur if word ``i`` occurs ``n[i]`` times."""
    sizes = np.diff(np.flatnonzero(codes == 0), prepend=-1)
    inside = np.flatnonzero((codes[:-1] != 0) & (codes[1:] != 0))
    weight = np.repeat(n, sizes)[inside].astype(np.float64)
    seen = np.zeros(int(codes.max()) + 1, bool)
    seen[codes] = True
    ids = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.int64)
    place[ids] = np.arange(len(ids))
    key = place[codes[inside]] * len(ids) + place[codes[inside + 1]]
    if len(ids) ** 2 <= 1 << 22:
        sums = np.bincount(key, weight, len(ids) ** 2)
        keys = np.flatnonzero(sums)
        sums = sums[keys]
    else:
        keys, back = np.unique(key, return_inverse=True)
        sums = np.bincount(back, weight, len(keys))
    return ids[keys // len(ids)] << 32 | ids[keys % len(ids)], sums.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"codes": [encoded(held).tobytes()], "n": [np.array(times, np.int64).tobytes()]})

    held, times, size = [], [], 0
    for batch in batches:
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.append(w)
            times.append(n)
            size += len(w)
            if size >= BLOCK:
                yield made()
                held, times, size = [], [], 0
    if held:
        yield made()


def _after(batches: Iterator[pa.RecordBatch], steps: Sequence[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, bytes]]:
    for batch in batches:
        for codes, n in zip(batch.column(0), batch.column(1), strict=True):
            c = np.frombuffer(codes.as_buffer(), np.int32)
            for step in steps:
                c = put_together(c, *step)
            yield c, n.as_py()


def settled(ranked: Sequence[tuple[int, tuple[str, str]]], limit: int) -> Iterator[tuple[str, str]]:
    """The next merges that follow from one count of pairs, ``ranked`` by count and text; others occur ``limit`` times at most.

    A merge of (a, b) changes only pairs that end in a or begin with b, and a pair that it makes stands for one of those. So
    as long as the next pair is more frequent than all of them it is neither changed nor overtaken.
    """
    for i, (n, pair) in enumerate(ranked):
        if i and n <= limit:
            return
        yield pair
        limit = max([limit, *(m for m, (a, b) in ranked if b == pair[0] or a == pair[1])])


def learn_bpe(docs: DataFrame, text: str, merges: int, least: int = 2) -> list[tuple[str, str]]:
    """What ``learn_merges`` makes of the counts of all words, which stay in Spark.

    The words are blocks of codes in ``spark.checkpoint.dir``. Each round applies the merges since the blocks were last
    written, adds up the counts of pairs, and takes the ``RANKED`` most frequent ones to the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    root = folder(spark, "bpe")
    made: list[str] = []
    steps: list[tuple[int, int, int]] = []
    out: list[tuple[str, str]] = []
    schema = "codes binary, n binary"

    def name(code: int) -> str:
        return made[code - MADE] if code >= MADE else chr(code - ENDED) + END if code >= ENDED else chr(code - 1)

    def code(symbol: str) -> int | None:
        if len(symbol) == 1:
            return ord(symbol) + 1
        if len(symbol) == 1 + len(END) and symbol.endswith(END):
            return ord(symbol[0]) + ENDED
        return MADE + made.index(symbol) if symbol in made else None

    def remove(path: str) -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def written(df: DataFrame, k: int) -> DataFrame:
        df.write.parquet(f"{root}/{k}")
        return spark.read.schema(schema).parquet(f"{root}/{k}")

    def ranked(blocks: DataFrame) -> tuple[list[tuple[int, tuple[str, str]]], int]:
        now = tuple(steps)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [pair_counts(c, np.frombuffer(n, np.int64)) for c, n in _after(batches, now)]
            if found:
                keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                sums = np.zeros(len(keys), np.int64)
                np.add.at(sums, back, np.concatenate([s for _, s in found]))
                yield pa.RecordBatch.from_pydict({"pair": keys, "n": sums})

        most, pairs = RANKED, blocks.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        while True:
            rows = pairs.orderBy(F.desc("n")).limit(most).collect()
            if len(rows) < most or rows[0].n > rows[-1].n:
                break
            most *= 4
        top = sorted(((r.n, (name(r.pair >> 32), name(r.pair & 0xFFFFFFFF))) for r in rows if r.n >= least), reverse=True)
        return top, rows[-1].n if len(rows) == most else 0

    try:
        counted = docs.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        blocks, k = written(counted.mapInArrow(_blocks, schema), 0), 0
        while len(out) < merges:
            if len(steps) >= KEPT_STEPS:
                now = tuple(steps)

                def rewrite(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
                    for c, n in _after(batches, now):
                        yield pa.RecordBatch.from_pydict({"codes": [c.tobytes()], "n": [n]})

                blocks, k = written(blocks.mapInArrow(rewrite, schema), k + 1), k + 1
                remove(f"{root}/{k - 1}")
                steps.clear()
            top, limit = ranked(blocks)
            if not top:
                break
            for pair in settled(top, limit):
                first, second, new = code(pair[0]), code(pair[1]), code("".join(pair))
                fresh = new is None
                if fresh:
                    made.append("".join(pair))
                    new = MADE + len(made) - 1
                steps.append((first, second, new))
                out.append(pair)
                if not fresh or len(out) == merges:  # pairs with a symbol that was there before may grow
                    break
    finally:
        remove(root)
    return out


def apply_bpe(df: DataFrame, text: str, merges: Sequence[tuple[str, str]], mark: str = "@@", kept: Sequence[str] = ()) -> Column:
    """The text in subwords; all but a word's last end in ``mark``."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    ranks, whole = {p: i for i, p in enumerate(merges)}, frozenset(kept)

    @arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        @lru_cache(100_000)
        def word(w: str) -> str:
            return (mark + " ").join(subwords(w, ranks, whole))

        return pa.array([None if t is None else " ".join(map(word, t.split())) for t in texts.to_pylist()], pa.string())

    return run(F.col(text))


def sentence_logprob(model: Mapping[tuple[str, ...], tuple[float, float]], sentence: Sequence[str], order: int, unknown: str = "<unk>") -> float:
    """Base-10 log probability of a sentence with its marks under a back-off model of (log p, back-off) by n-gram."""

    def of(history: tuple[str, ...], w: str) -> float:
        found = model.get((*history, w))
        if found is not None:
            return found[0]
        if not history:
            return model.get((unknown,), (-math.inf, 0.0))[0]
        return model.get(history, (0.0, 0.0))[1] + of(history[1:], w)

    known = [w if (w,) in model else unknown for w in sentence]
    line = ["<s>", *known, "</s>"]
    return sum(of(tuple(line[max(0, i - order + 1) : i]), line[i]) for i in range(1, len(line)))


def joined_scores(df: DataFrame, key: str, text: str, model: DataFrame, order: int, unknown: str = "<unk>") -> DataFrame:
    """(key, logp): log probability of each text under an ARPA table (order, gram, logp, backoff) of any size; no row without words.

    Each place asks for its n-grams of all orders and for their histories' back-off weights, by joins; the longest n-gram
    that the model has counts, with the weights of the longer histories that it backs off from.
    """
    marked = F.concat(F.array(F.lit("<s>")), words(F.col(text)), F.array(F.lit("</s>")))
    flat = df.select(key, F.posexplode(marked).alias("pos", "w"))
    place = W.partitionBy(key).orderBy("pos")
    last = F.collect_list("w").over(place.rowsBetween(1 - order, 0))  # a place's n-grams end in it; any of their words may be unknown
    either = lambda i: F.array_distinct(F.array(F.get("last", i), F.lit(unknown)))
    longer = lambda g, k: F.flatten(F.transform(either(F.size("last") - k), lambda w: F.transform(g, lambda x: F.concat_ws(" ", w, x))))
    every = [either(F.size("last") - 1)]
    for k in range(2, order + 1):
        every.append(F.when(F.size("last") >= k, longer(every[-1], k)).otherwise(F.array().cast("array<string>")))
    grams = flat.select(last.alias("last")).select(F.explode(F.concat(*every)).alias("gram")).distinct()
    grams = written(grams)
    if grams.count() <= ASKED:  # else the model is shuffled, however large
        grams = F.broadcast(grams)
    model = written(model.join(grams, "gram", "left_semi"))  # read once, whole; what the texts can't ask for is not handed on
    of = lambda n: model.filter(F.col("order") == n)
    known = of(1).select(F.col("gram").alias("w"), F.lit(True).alias("known")).distinct()
    flat = flat.join(known, "w", "left").select(key, "pos", F.when(F.col("known") | F.col("w").isin("<s>", "</s>"), F.col("w")).otherwise(F.lit(unknown)).alias("w"))
    back = lambda k: F.lag("w", k).over(place) if k else F.col("w")
    gram = lambda first, last: F.when(F.col("pos") >= first, F.concat_ws(" ", *[back(k) for k in range(first, last - 1, -1)]))
    asked = flat.select(key, "pos", *[gram(n - 1, 0).alias(f"g{n}") for n in range(1, order + 1)], *[gram(n - 1, 1).alias(f"h{n}") for n in range(2, order + 1)]).filter("pos > 0")
    for n in range(1, order + 1):
        asked = asked.join(of(n).select(F.col("gram").alias(f"g{n}"), F.col("logp").alias(f"p{n}")), f"g{n}", "left")
        if n > 1:
            asked = asked.join(of(n - 1).select(F.col("gram").alias(f"h{n}"), F.col("backoff").alias(f"b{n}")), f"h{n}", "left")
    missing = of(1).filter(F.col("gram") == unknown).agg(F.coalesce(F.max("logp"), F.lit(float("-inf"))).alias("none"))  # one row
    logp = F.coalesce("p1", "none")
    for n in range(2, order + 1):
        logp = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"b{n}"), F.lit(0.0)) + logp)
    return asked.crossJoin(F.broadcast(missing)).groupBy(key).agg(F.sum(logp).alias("logp"))


def score_sentences(df: DataFrame, text: str, model: DataFrame, most_grams: int = 500_000) -> Column:
    """The same as a column, for an ARPA table of at most ``most_grams`` rows, which go to every worker; more are an error."""
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    if model.count() > most_grams:
        raise ValueError("the model is too large to be sent to every worker")
    rows = model.collect()
    order = max((r.order for r in rows), default=1)
    sent = df.sparkSession.sparkContext.broadcast({tuple(r.gram.split(" ")): (r.logp, r.backoff) for r in rows})

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else sentence_logprob(sent.value, t.split(), order) for t in texts.to_pylist()], pa.float64())

    return run(F.col(text))


def kn_levels(docs: DataFrame, text: str, order: int) -> list[DataFrame]:
    """For orders 1 to ``order``: (history, word, c, k), counts of n-grams and of the distinct words before them, with sentence marks.

    The highest n-grams are counted in the texts; a lower one's count is that of all that end in it, and of the texts that
    begin with it, which have no word before it.
    """
    w = F.concat(F.array(F.lit("<s>")), words(F.lower(F.col(text))), F.array(F.lit("</s>")))
    lines = docs.select(w.alias("__w"))
    gram = F.when(F.size("__w") >= order, F.transform(F.sequence(F.lit(1), F.size("__w") - order + 1), lambda i: F.slice("__w", i, order)))
    level = written(lines.select(F.explode(gram).alias("g")).groupBy("g").agg(F.count("*").alias("c")))
    out = [level.withColumn("k", F.lit(0).cast("long"))]
    for n in range(order - 1, 0, -1):
        starts = lines.filter(F.size("__w") >= n).groupBy(F.slice("__w", 1, n).alias("g")).agg(F.count("*").alias("c"), F.lit(0).cast("long").alias("k"))
        ends = level.groupBy(F.slice("g", 2, n).alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("k"))
        level = written(ends.unionByName(starts).groupBy("g").agg(F.sum("c").alias("c"), F.sum("k").alias("k")))
        out.append(level)
    return [d.select(F.slice("g", 1, n).alias("history"), F.element_at("g", -1).alias("word"), "c", "k") for n, d in enumerate(reversed(out))]


def kn_model(docs: DataFrame, text: str, order: int = 3) -> DataFrame:
    """(order, gram, logp, backoff): a Kneser-Ney model of any order that backs off, as ``joined_scores`` and ARPA files have it.

    D is n1 / (n1 + 2 n2) of an order's counts, 0 for single words.  f is (c - D) over the history's sum at the highest order, and the same of
    distinct words before below it; histories that only begin texts have no such words, and keep their counts.  A
    history's weight is what its f leave, over what the same words leave in the history without its first word; where these
    leave nothing there is no word to back off to, and its f are raised to a sum of one.
    """
    below, levels, weights = None, [], []
    for n, d in enumerate(kn_levels(docs, text, order)):
        n1, n2 = d.agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
        discount = n1 / (n1 + 2 * n2) if n and n1 else 0.0
        total = d.groupBy("history").agg(F.sum("c").alias("all"), F.sum("k").alias("kinds"))
        by_kind = (F.col("kinds") > 0) & F.lit(n < order - 1)
        f = F.greatest(F.lit(0.0), F.when(by_kind, F.col("k")).otherwise(F.col("c")) - discount) / F.when(by_kind, F.col("kinds")).otherwise(F.col("all"))
        level = d.join(total, "history").select("history", "word", f.alias("f"))
        if below is not None:
            lower = below.select(F.col("history").alias("short"), "word", F.col("f").alias("lower"))
            both = written(level.withColumn("short", F.slice("history", 2, n)).join(lower, ["short", "word"]))
            left = both.groupBy("history").agg((1 - F.sum("f")).alias("a"), (1 - F.sum("lower")).alias("b"))
            level = both.join(left, "history").select("history", "word", F.when(F.col("b") > 1e-12, F.col("f")).otherwise(F.col("f") / (1 - F.col("a"))).alias("f"))
            weights.append(left.filter("a > 1e-12 AND b > 1e-12").select(F.col("history").alias("gram"), F.log10(F.col("a") / F.col("b")).alias("backoff")))
        below = written(level)
        levels.append(below)
    parts = []
    for n, level in enumerate(levels):
        own = level.select(F.lit(n + 1).alias("order"), F.concat("history", F.array("word")).alias("gram"), F.when(F.col("f") > 0, F.log10("f")).otherwise(-99.0).alias("logp"))
        own = own.join(weights[n], "gram", "left") if n < len(weights) else own.withColumn("backoff", F.lit(None).cast("double"))
        parts.append(own.select("order", F.array_join("gram", " ").alias("gram"), "logp", "backoff"))
    return reduce(DataFrame.unionByName, parts)


def arpa_lines(model: DataFrame) -> DataFrame:
    """value: the lines of n-grams in the usual text format."""
    number = lambda c: F.format_string("%.7f", c)
    return model.select(F.concat(number("logp"), F.lit("\t"), F.col("gram"), F.when(F.col("backoff").isNotNull(), F.concat(F.lit("\t"), number("backoff"))).otherwise("")).alias("value"))

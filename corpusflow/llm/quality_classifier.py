"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text are cut into bins.  Boosting goes round the features in a cycle; each turn fits a
shallow tree over one feature's bins to the logistic gradient and adds it to that feature's lookup
table, so the sum of the turns is one table a feature.  Then the pairs of features that explain most
of what is left get tables over both features' bins in the same way.  A score is the logistic of a
sum of looked-up entries.

Training uses at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of the id; scores use the
text alone.  Defined results: null and empty texts have features (zeros) and a score like any other;
without any label every score is 0.5; a document labelled twice takes the lower label; labels that
are null are ignored; texts are measured whole; of splits that gain alike the first is taken; rows with a null id are
scored and never learned from; repeated rows get equal scores; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.arrow import crc_bucket, scored
from corpusflow.llm.quality_rules import MEASURES, measure

TRAIN_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.15
RIDGE = 1.0
THRESHOLD = 0.3
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "words_a_line", "upper_share", "mark_share", "digit_share", "punct_share", "high_share", "distinct_share", "longest_word", "byte_entropy")
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_HIGH = np.arange(256) >= 0x80
_PUNCT = np.array([0x21 <= b < 0x7F and not chr(b).isalnum() for b in range(256)])


def features(raw: list) -> list[list[float]]:
    """The features of each text, in the order of ``FEATURES``."""
    if not raw:
        return [[] for _ in FEATURES]
    m = dict(zip(MEASURES, (np.array(x, float) for x in measure(raw)), strict=True))
    more = np.zeros((len(raw), 6))
    for i, b in enumerate(raw):
        if not b:
            continue
        n = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
        p = n[n > 0] / len(b)
        words = b.split()
        more[i] = n[_DIGIT].sum(), n[_PUNCT].sum(), n[_HIGH].sum(), len(set(words)), max(map(len, words), default=0), -(p * np.log2(p)).sum()
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1)
    lines = np.maximum(m["n_lines"], 1)
    cols = (np.log1p(m["n_words"]), chars / words, m["n_symbols"] / words, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, words / lines, m["n_upper"] / chars, m["n_marks"] / words, more[:, 0] / chars, more[:, 1] / chars, more[:, 2] / chars, more[:, 3] / words, more[:, 4], more[:, 5])
    return [c.tolist() for c in cols]


@dataclass
class Gam:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Newton steps by bin: a tree of ``depth`` over ordered bins with gradient and curvature sums."""
    out = np.zeros(len(g))

    def split(a: int, b: int, left: int) -> None:
        cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        best = 0
        if left and b - a > 1:
            gains = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
            best = int(gains.argmax()) + 1
            if gains[best - 1] <= _gain(cg[-1], ch[-1]) + 1e-9:
                best = 0
        if best:
            split(a, a + best, left - 1)
            split(a + best, b, left - 1)
        else:
            out[a:b] = -cg[-1] / (ch[-1] + RIDGE)

    split(0, len(g), depth)
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps over a grid of two features' bins, from a split of the first and one of the second on either side; and the gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, where = -1.0, (1, 1, 1)
    for a in range(1, len(g)):
        lg, lh = cg[a - 1], ch[a - 1]
        sides = []
        for sg, sh in ((lg, lh), (cg[-1] - lg, ch[-1] - lh)):
            gains = _gain(sg[:-1], sh[:-1]) + _gain(sg[-1] - sg[:-1], sh[-1] - sh[:-1])
            k = int(gains.argmax())
            sides.append((float(gains[k]), k + 1))
        total = sides[0][0] + sides[1][0]
        if total > best:
            best, where = total, (a, sides[0][1], sides[1][1])
    a, left, right = where
    out = np.zeros_like(g)
    for rows, k in ((slice(0, a), left), (slice(a, None), right)):
        for cols in (slice(0, k), slice(k, None)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return out, best - float(_gain(g.sum(), h.sum()))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="inverted_cdf"))


def fit_gam(x: np.ndarray, y: np.ndarray) -> Gam:
    """x: rows by features; y: 0 or 1."""
    gam = Gam()
    if not len(y):
        return gam
    rate = (y.sum() + 1) / (len(y) + 2)
    gam.base = float(np.log(rate / (1 - rate)))
    k = x.shape[1]
    gam.edges = [_edges(x[:, j], BINS) for j in range(k)]
    gam.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(gam.edges)]
    gam.tables = [np.zeros(len(e) + 1) for e in gam.edges]
    z = np.full(len(y), gam.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(k):
            g, h = slopes()
            n = len(gam.tables[j])
            step = RATE * shallow_tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            gam.tables[j] += step
            z += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(gam.pair_edges)]
    sizes = [len(e) + 1 for e in gam.pair_edges]
    cell = lambda a, b: coarse[a] * sizes[b] + coarse[b]

    def grid(a: int, b: int, s: np.ndarray) -> np.ndarray:
        return np.bincount(cell(a, b), s, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    g, h = slopes()
    usable = [(a, b) for a in range(k) for b in range(a + 1, k) if sizes[a] > 1 and sizes[b] > 1]
    gam.pairs = sorted(sorted(usable, key=lambda p: -quadrants(grid(*p, g), grid(*p, h))[1])[:PAIRS])
    gam.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in gam.pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (a, b) in enumerate(gam.pairs):
            g, h = slopes()
            step = RATE * quadrants(grid(a, b, g), grid(a, b, h))[0]
            gam.pair_tables[i] += step
            z += step.reshape(-1)[cell(a, b)]
    return gam


def score(gam: Gam, x: np.ndarray) -> np.ndarray:
    """Probabilities of label 1: bin additions, a column at a time."""
    z = np.full(len(x), gam.base)
    for j, (e, t) in enumerate(zip(gam.edges, gam.tables, strict=True)):
        z += t[np.searchsorted(e, x[:, j], side="right")]
    for (a, b), t in zip(gam.pairs, gam.pair_tables, strict=True):
        z += t[np.searchsorted(gam.pair_edges[a], x[:, a], side="right"), np.searchsorted(gam.pair_edges[b], x[:, b], side="right")]
    return 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, held_out=lambda key: crc_bucket(key, 5) == 0) -> Gam:
    """A model of at most ``rows`` labelled documents outside ``held_out``; only they are measured."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    made = scored(texts, features, [(f, T.DoubleType()) for f in FEATURES], ("doc_id", "quality"))
    got = sorted(made.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(2 * rows).collect())  # repeated ids could swell it
    table = np.array([[float(v) for v in r] for r in got]).reshape(-1, 2 + len(FEATURES))
    return fit_gam(table[:, 2:], (table[:, 1] > 0).astype(float))


def score_documents(docs: DataFrame, gam: Gam) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""
    return scored(docs, lambda raw: [score(gam, np.array(features(raw)).T.reshape(-1, len(FEATURES)))], [("score", T.DoubleType())])


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned outside the held-out fifth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return made.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

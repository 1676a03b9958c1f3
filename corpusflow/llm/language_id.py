"""Language identification by a byte convolutional network.

Texts are cut into fixed-length windows of bytes, all of them, the last one padded with zero bytes.
Bytes are embedded; filters of several widths slide over the window; each filter's maximum over the
window, rectified, feeds a softmax.  Trained here in numpy (Adam, cross-entropy) on a bounded sample:
at most ``PER_LANG`` labelled documents a language, chosen by a hash of the id, and of those at most
``TRAIN_WINDOWS`` windows a document spread evenly over it.  A text's logits are the byte-weighted
mean of its windows' logits.  The trained weights are rounded to whole multiples of small powers of two, so that all
sums of a window are exact in the numbers that hold them: scores are a function of the text alone, whatever lies beside
it in a batch and however the products are ordered.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text when
no labelled text was given; texts are read whole, window by window; of languages with equal probability the first by
name is taken; a document with a null id counts as one whose id is the empty text; repeated rows get equal results; an
empty table gives no row; extra columns are ignored by the query and kept by ``keep_known``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.arrow import crc_bucket, fresh, scored, with_kernel
from corpusflow.llm.scratch import small

LENGTH = 256
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANG = 400
#: The sample is bounded by this many languages, too (repeated ids could swell it).
MAX_LANGS = 200
TRAIN_WINDOWS = 4
EPOCHS = 5
UNKNOWN = "und"
LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Net:
    """``kernel`` holds all filters at the widest width, zero where a filter is narrower."""

    langs: list[str]
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


#: Weights are multiples of these: a product of an embedding and a kernel takes 17 bits, a sum of 32 of them 22, and single
#: precision holds 24.
EMBED_STEP, KERNEL_STEP, DENSE_STEP = 2.0**-6, 2.0**-7, 2.0**-12
#: Larger embeddings and kernel weights are cut to this.
MOST_WEIGHT = 4.0 - 2.0**-6


def rounded(net: Net) -> Net:
    """The net with weights on the grid that makes its sums exact."""
    grid = lambda a, step, most: np.clip(np.rint(a / step) * step, -most, most)
    return Net(net.langs, grid(net.embed, EMBED_STEP, MOST_WEIGHT).astype(np.float32), grid(net.kernel, KERNEL_STEP, MOST_WEIGHT).astype(np.float32), grid(net.bias.astype(np.float64), EMBED_STEP * KERNEL_STEP, 256.0), grid(net.dense.astype(np.float64), DENSE_STEP, 64.0), grid(net.offset.astype(np.float64), EMBED_STEP * KERNEL_STEP * DENSE_STEP, 64.0))


def kernel_mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS), EMBED, len(WIDTHS) * FILTERS), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask.reshape(max(WIDTHS) * EMBED, -1)


def unfold(embed: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(windows * positions, width * embedding): what lies under the filters at each position."""
    n, wide = len(windows), max(WIDTHS)
    x = np.zeros((n, LENGTH + wide - 1, EMBED), np.float32)
    np.take(embed, windows, axis=0, out=x[:, :LENGTH])
    s = x.strides
    return np.lib.stride_tricks.as_strided(x, (n, LENGTH, wide * EMBED), (s[0], s[1], s[2])).reshape(n * LENGTH, -1)


def logits(net: Net, windows: np.ndarray, chunk: int = 16) -> np.ndarray:
    """Logits of windows in steps of EMBED_STEP * KERNEL_STEP * DENSE_STEP, as whole numbers; exact for a rounded net."""
    out = np.empty((len(windows), len(net.langs)), np.int64)
    unit = EMBED_STEP * KERNEL_STEP * DENSE_STEP
    for i in range(0, len(windows), chunk):
        w = windows[i : i + chunk]
        pooled = (unfold(net.embed, w) @ net.kernel).reshape(len(w), LENGTH, -1).max(axis=1).astype(np.float64) + net.bias
        out[i : i + chunk] = (np.maximum(pooled, 0) @ net.dense + net.offset) / unit
    return out


def cut(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, and the number of windows of each (one at least)."""
    counts = np.array([max(1, -(-len(b) // LENGTH)) for b in raw], np.int64)
    flat = b"".join(b.ljust(int(n) * LENGTH, b"\0") for b, n in zip(raw, counts, strict=True))
    return np.frombuffer(flat, np.uint8).reshape(-1, LENGTH), counts


def gradients(p: dict[str, np.ndarray], w: np.ndarray, y: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The weighted mean cross-entropy of windows ``w`` with languages ``y``, and its gradient by each parameter."""
    n, f = len(w), p["bias"].shape[0]
    cols = unfold(p["embed"], w)
    conv = (cols @ p["kernel"]).reshape(n, LENGTH, f)
    at = conv.argmax(axis=1)
    pooled = np.take_along_axis(conv, at[:, None], 1)[:, 0] + p["bias"]
    hidden = np.maximum(pooled, 0)
    z = hidden @ p["dense"] + p["offset"]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    d = e / e.sum(axis=1, keepdims=True)
    loss = float(-(np.log(d[np.arange(n), y]) * weight).sum() / n)
    d[np.arange(n), y] -= 1
    d *= weight[:, None] / n
    back = (d @ p["dense"].T) * (pooled > 0)
    under = cols.reshape(n, LENGTH, -1)[np.arange(n)[:, None], at]
    grad = {"dense": hidden.T @ d, "offset": d.sum(0), "bias": back.sum(0), "kernel": np.einsum("nfk,nf->kf", under, back) * mask}
    spread = (back[:, :, None] * p["kernel"].T[None]).reshape(n, f, max(WIDTHS), EMBED)
    where = at[:, :, None] + np.arange(max(WIDTHS))
    padded = np.pad(w, ((0, 0), (0, max(WIDTHS) - 1)))
    grad["embed"] = np.zeros_like(p["embed"])
    np.add.at(grad["embed"], padded[np.arange(n)[:, None, None], where], spread)
    grad["embed"][0] = 0
    return loss, grad


def train(texts: list[bytes], langs: list[str], seed: int = 0, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01) -> Net | None:
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    windows, target = [], []
    for b, lang in zip(texts, langs, strict=True):
        w, n = cut([b])
        pick = np.unique(np.linspace(0, n[0] - 1, min(int(n[0]), TRAIN_WINDOWS)).astype(int))
        windows.append(w[pick])
        target += [names.index(lang)] * len(pick)
    x, y = np.concatenate(windows), np.array(target)
    per_class = np.bincount(y, minlength=len(names))
    weight = (len(y) / len(names) / np.maximum(per_class, 1))[y].astype(np.float32)
    mask, f = kernel_mask(), len(WIDTHS) * FILTERS
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        "kernel": rng.normal(0, 0.3, mask.shape).astype(np.float32) * mask,
        "bias": np.zeros(f, np.float32),
        "dense": rng.normal(0, 0.3, (f, len(names))).astype(np.float32),
        "offset": np.zeros(len(names), np.float32),
    }
    p["embed"][0] = 0
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            grad = gradients(p, x[part], y[part], weight[part], mask)[1]
            step += 1
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return rounded(Net(names, **p))


def predict(net: Net | None, raw: list) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(raw), [0.0] * len(raw)
    lettered = [i for i, b in enumerate(raw) if b and (LETTER.search(b) or any(map(str.isalpha, b.decode())))]
    if net is None or not lettered:
        return langs, scores
    windows, counts = cut([raw[i] for i in lettered])
    filled = (windows != 0).sum(axis=1)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    sums = np.add.reduceat(logits(net, windows) * filled[:, None], first)
    unit = EMBED_STEP * KERNEL_STEP * DENSE_STEP
    for i, z, n in zip(lettered, sums.tolist(), np.add.reduceat(filled, first).tolist(), strict=True):
        z = [x / n * unit for x in z]
        top = max(z)
        langs[i], scores[i] = net.langs[z.index(top)], 1 / sum(math.exp(x - top) for x in z)
    return langs, scores


def fit(docs: DataFrame, per_lang: int = PER_LANG, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out=lambda key: crc_bucket(key, 3) == 1) -> Net | None:
    """A net learned from at most ``per_lang`` documents of each language outside ``held_out``.

    With more than ``MAX_LANGS`` languages each has a smaller share, one document at least; within it the hash of the id decides.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    plain = known.select(F.col(key).alias("id"), F.col(lang).alias("lang"))
    rates = plain.groupBy("lang").agg((F.lit(2_000_000.0 * per_lang) / F.count("*")).alias("rate"))
    few = plain.join(small(rates), "lang").filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.col("rate"))  # about twice as many as are asked for
    order = W.partitionBy("lang").orderBy(F.pmod(F.xxhash64("id"), F.lit(1_000_000)), "id")
    ids = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_lang).select("id").distinct()
    sample = known.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(F.broadcast(ids), "id", "left_semi")
    share = min(per_lang, max(1, per_lang * MAX_LANGS // max(1, rates.count())))
    order = W.partitionBy("lang").orderBy(F.pmod(F.xxhash64("id"), F.lit(1_000_000)), "id", "text")
    sample = sample.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= share)
    rows = sorted(sample.collect(), key=lambda r: (r.id, r.lang, r.text))
    return train([r.text.encode() for r in rows], [r.lang for r in rows])


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out third."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = fit(docs)
    made = scored(docs, lambda raw: predict(net, raw), [("lang_pred", T.StringType()), ("score", T.DoubleType())])
    return made.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, net: Net | None, least: float = 0.4, text: str = "text") -> DataFrame:
    """The documents whose language is known with a score of ``least`` at least, as they came; all if no net could be learned."""
    if net is None:
        return docs
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    made = with_kernel(docs, lambda raw: predict(net, raw), [(lang, T.StringType()), (score, T.DoubleType())], text)
    return made.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Learning of pronunciations: choosing among those of a reference lexicon (R), spelling rules (G) and phonetic decoding (P)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.session import ship

SOURCES = ("R", "G", "P")
#: Distinct rows of soft counts that one word may have; more is an error, since a word's rows meet in one task.
MOST_ROWS = 2_000_000
MOST_ROUNDS = 10_000


def candidates(reference: DataFrame, rules: DataFrame, decoded: DataFrame, seen: DataFrame, silence: Sequence[str] = ()) -> DataFrame:
    """(word, pron, source) of the three lexicons, for words in ``seen`` (word); decoded ones with a phone of silence go."""
    quiet = F.lit(False) if not silence else F.arrays_overlap(F.split("pron", " "), F.array(*map(F.lit, silence)))
    parts = [d.select("word", "pron", F.lit(s).alias("source")) for s, d in zip(SOURCES, (reference, rules, decoded.filter(~quiet)), strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct().join(seen.select("word").distinct(), "word", "left_semi")


def best_source(c: DataFrame) -> DataFrame:
    """(word, pron, source): the reference before the rules before decoding."""
    rank = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source"))
    return c.groupBy("word", "pron").agg(F.min_by("source", rank).alias("source"))


def pron_posteriors(c: DataFrame, counts: DataFrame, prior_mean: Mapping[str, float], prior_total: float = 15.0) -> DataFrame:
    """(word, pron, source, posterior): soft counts (word, pron, n) with a prior by source, divided by their sum for the word.

    The prior's mean is shared among the sources that the word has, and a source's part among its pronunciations there.
    A pronunciation of two sources has a row, and its count, for each.
    """
    mean = F.element_at(F.create_map(*[x for s in SOURCES for x in (F.lit(s), F.lit(float(prior_mean[s])))]), F.col("source"))
    per = c.groupBy("word", "source").agg(F.count("*").alias("held")).withColumn("mean", mean)
    per = per.withColumn("prior", prior_total * F.col("mean") / F.sum("mean").over(W.partitionBy("word")) / F.col("held"))
    d = c.join(per.select("word", "source", "prior"), ["word", "source"]).join(counts.select("word", "pron", "n"), ["word", "pron"], "left")
    return d.withColumn("mass", F.col("prior") + F.coalesce("n", F.lit(0.0))).select("word", "pron", "source", (F.col("mass") / F.sum("mass").over(W.partitionBy("word"))).alias("posterior"))


def select_by_posterior(posteriors: DataFrame, variants: int = 1, mass: float = 0.7, reference_mass: float = 0.9) -> DataFrame:
    """(word, pron): the most probable pronunciations until their number or their mass is enough, with all that equal the last one;
    then further ones of the reference until ``reference_mass``.

    A word of the reference may have half as many again as it has there (rounded up).  Equals are taken P before G before R, then by
    text.
    """
    rank = F.array_position(F.array(*map(F.lit, reversed(SOURCES))), F.col("source"))
    w = W.partitionBy("word").orderBy(F.desc("posterior"), rank, "pron")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    known = posteriors.filter("source = 'R'").select("word", "pron").withColumn("known", F.lit(True))
    d = posteriors.join(known, ["word", "pron"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    own = F.count_if(F.col("source") == "R").over(W.partitionBy("word"))
    d = d.withColumn("most", F.when(own > 0, F.ceil(1.5 * own)).otherwise(variants)).withColumn("k", F.row_number().over(w)).withColumn("sum", F.coalesce(F.sum("posterior").over(before), F.lit(0.0)))
    enough = ~((F.col("k") - 1 < F.col("most")) & (F.col("sum") < mass)) & ~F.coalesce(F.lag("posterior").over(w) == F.col("posterior"), F.lit(False))
    d = d.withColumn("enough", enough).withColumn("first", F.coalesce(F.count_if("enough").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) == 0, F.lit(False)))
    # of the rest, what the reference has
    have, held = (f(F.when(F.col("first"), v)).over(W.partitionBy("word")) for f, v in ((F.count, F.lit(1)), (F.sum, F.col("posterior"))))
    d = d.withColumn("have", have).withColumn("held", held).withColumn("more", ~F.col("first") & F.col("known"))
    count, total = F.count_if("more").over(before), F.sum(F.when(F.col("more"), F.col("posterior"))).over(before)
    d = d.withColumn("count", F.coalesce(count, F.lit(0))).withColumn("total", F.coalesce(total, F.lit(0.0)))
    late = F.col("more") & (F.col("have") + F.col("count") < F.col("most")) & (F.col("held") + F.col("total") < reference_mass)
    return d.filter(F.col("first") | late).select("word", "pron").distinct()


def em_step(soft: np.ndarray, times: np.ndarray, prob: np.ndarray) -> tuple[np.ndarray, float]:
    """One round of expectation and maximisation: shares of pronunciations, and the mean log likelihood, of rows met so many ``times``."""
    joint = soft * (prob / prob.sum())
    row = joint.sum(axis=1)
    n = times.sum()
    return (joint / row[:, None] * times[:, None]).sum(axis=0) / n, float((np.log(row) * times).sum() / n)


def settled_shares(soft: np.ndarray, times: np.ndarray, prob: np.ndarray, close: float) -> tuple[np.ndarray, float]:
    """Rounds until the likelihood changes by no more than ``close``; an error if it doesn't settle."""
    last = None
    for _ in range(MOST_ROUNDS):
        prob, now = em_step(soft, times, prob)
        if last is not None and abs(now - last) <= close:
            return prob, now
        last = now
    raise RuntimeError(f"likelihoods have not settled after {MOST_ROUNDS} rounds")


def _without(prob: np.ndarray, gone: int, active: list[int]) -> np.ndarray:
    """Shares with one pronunciation at none, and a hundredth more for all others that are left."""
    out = prob.copy()
    out[gone] = 0.0
    out[[j for j in active if j != gone]] += 0.01
    return out / out.sum()


def greedy_choice(soft: np.ndarray, times: np.ndarray, sources: Sequence[str], alpha: Mapping[str, float], beta: Mapping[str, float], delta: float) -> list[int]:
    """Pronunciations that are left when the one whose loss costs least likelihood goes, again and again, as long as one costs less than its source's threshold."""
    soft, n = np.maximum(soft, delta), float(times.sum())
    prob, active = np.full(soft.shape[1], 1.0 / soft.shape[1]), list(range(soft.shape[1]))
    while len(active) > 1:
        prob, full = settled_shares(soft, times, prob, 1e-7)
        scores = []
        for i in active:
            _, less = settled_shares(soft, times, _without(prob, i, active), 1e-3)
            scores.append(((full - less) * n / (n + beta[sources[i]]) + alpha[sources[i]] * math.log(delta), i))
        score, worst = min(scores)
        if score >= 0:
            break
        active.remove(worst)
        prob = _without(prob, worst, [*active, worst])
    return active


def select_greedily(c: DataFrame, arcs: DataFrame, alpha: Mapping[str, float] | None = None, beta: Mapping[str, float] | None = None, delta: float = 1e-9) -> DataFrame:
    """(word, pron) kept of ``c``, by soft counts of arcs (word, utt, start, pron, n): ``greedy_choice`` for each word that has arcs.

    Places where the same was heard are counted before they go to their word's pronunciations, and equal rows of soft counts before they
    meet in a word's task, which holds its distinct rows: ``MOST_ROWS`` at most.
    Shares of a word with one pronunciation need no arcs, but words without any are left out.
    """
    ship(c.sparkSession)
    alpha, beta = ({s: float((x or {}).get(s, 0)) for s in SOURCES} for x in (alpha, beta))
    prons = best_source(c).groupBy("word").agg(F.array_sort(F.collect_list(F.struct("pron", "source"))).alias("prons"))
    places = arcs.groupBy("word", "utt", "start").agg(F.array_sort(F.collect_list(F.struct("pron", "n"))).alias("heard"))
    kinds = places.groupBy("word", "heard").agg(F.count("*").alias("times")).withColumn("soft", F.map_from_entries("heard"))
    rows = kinds.join(prons, "word").select("word", "prons", "times", F.transform("prons", lambda p: F.coalesce(F.try_element_at("soft", p["pron"]), F.lit(0.0)).cast("double")).alias("soft"))
    rows = rows.groupBy("word", "soft").agg(F.sum("times").alias("times"), F.first("prons").alias("prons"))

    def choose(group: pa.Table) -> pa.Table:
        if group.num_rows > MOST_ROWS:
            raise ValueError(f"more than {MOST_ROWS} distinct rows of soft counts for {group.column('word')[0]}")
        prons = group.column("prons")[0].as_py()
        soft, times = np.array(group.column("soft").to_pylist(), np.float64).reshape(group.num_rows, len(prons)), group.column("times").to_numpy()
        order = np.lexsort(soft.T[::-1])  # the same sums whatever order the rows came in
        kept = greedy_choice(soft[order], times[order], [p["source"] for p in prons], alpha, beta, delta)
        return pa.table({"word": pa.array([group.column("word")[0].as_py()] * len(kept), pa.string()), "pron": pa.array([prons[i]["pron"] for i in kept], pa.string())})

    return rows.groupBy("word").applyInArrow(choose, "word string, pron string")


def lexicon_edits(c: DataFrame, learned: DataFrame, counts: DataFrame) -> DataFrame:
    """(word, source, decision, n, pron): what to do with each pronunciation of words for which the lexicon of the reference would change; Y keeps it."""
    told = best_source(c).join(learned.select("word", "pron").distinct().withColumn("keep", F.lit(True)), ["word", "pron"], "left").withColumn("keep", F.coalesce("keep", F.lit(False)))
    changed = F.max(F.col("keep") != (F.col("source") == "R")).over(W.partitionBy("word"))
    known = F.max(F.col("source") == "R").over(W.partitionBy("word"))
    d = told.withColumn("changed", changed & known).filter("changed").join(counts.select("word", "pron", "n"), ["word", "pron"], "left")
    return d.select("word", "source", F.when(F.col("keep"), "Y").otherwise("N").alias("decision"), F.coalesce("n", F.lit(0.0)).alias("n"), "pron")


def edited_lexicon(lexicon: DataFrame, edits: DataFrame) -> DataFrame:
    """(word, pron) after edits (word, pron, decision): N takes one out, Y puts one in."""
    d = edits.select("word", "pron", "decision")
    kept = lexicon.select("word", "pron").join(d.filter("decision = 'N'"), ["word", "pron"], "left_anti")
    return kept.unionByName(d.filter("decision = 'Y'").select("word", "pron")).distinct()


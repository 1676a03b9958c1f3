"""Quality rules: a rule bitmask ledger.

Every document is measured once; every rule is evaluated once over the measurements and leaves
one bit in ``fail_bits``.  What is kept is decided later by versioned policies, which are masks
over those bits, and a rule's effect is found by bitwise aggregation over the ledger: no text is
read again for a new policy or an ablation.

Defined results: a null or empty text has no words and fails ``few_words``; texts are measured
whole, in work that grows with their length; repeated rows give repeated rows; an empty table gives an empty ledger; extra columns are ignored by ``ledger`` and
passed through by ``keep_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.arrow import fresh, scored, with_kernel
from corpusflow.llm.scratch import Scratch

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUATION = bytes(range(0x80, 0xC0))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; the rule owns bit ``bit`` for ever."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A document passes if it fails none of ``rules``."""

    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "shouting", "100 * n_upper > 40 * word_chars"),
    Rule(5, "exclamation", "100 * n_marks > 30 * n_words"),
    Rule(6, "long_words", "word_chars > 20 * n_words"),
    Rule(7, "short_words", "word_chars < 2 * n_words"),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = (BASE, Policy("web", 1, tuple(r.name for r in RULES if r.name not in ("long_words", "short_words"))), Policy("web", 2, tuple(r.name for r in RULES)))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n + 2)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) < 2_000_000:
        keys = pairs[:-1] * len(seen) + ids[2:]
    else:  # the product would not fit 63 bits: number the pairs first
        keys = np.unique(pairs, return_inverse=True)[1][:-1] * len(seen) + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    hit = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[hit + shift] = True
    return int(covered.sum())


def measure(raw: list) -> list[list[int]]:
    """The measurements of each text, in the order of ``MEASURES``."""
    rows = []
    for b in raw:
        if not b:
            rows.append((0,) * len(MEASURES))
            continue
        words = b.split()
        lines = [x for x in b.split(b"\n") if x.strip()]
        solid = b.translate(None, WHITE)
        chars = len(solid) if solid.isascii() else len(solid.translate(None, CONTINUATION))
        rows.append((len(words), chars, len(b) - len(b.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines), len(b) - len(b.translate(None, UPPER)), b.count(b"!")))
    return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in MEASURES]


def fail_bits(rules: Sequence[Rule] = RULES) -> Column:
    """All rules over the measurement columns, as one bitmask."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits + F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long")
    return bits


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bit = {r.name: 1 << r.bit for r in rules}
    return sum(bit[name] for name in policy.rules)


def passes(policy: Policy, bits: Column, rules: Sequence[Rule] = RULES) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``key``, the measurements, ``fail_bits``."""
    measured = scored(docs, measure, [(m, T.LongType()) for m in MEASURES], (key,), text)
    return measured.withColumn("fail_bits", fail_bits(rules))


def ablation(led: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each policy and rule: documents that fail it, that only it rejects, and that pass the policy.

    The ledger is first counted by ``fail_bits`` (at most 2^rules rows, combined map-side); the rest
    is bitwise work over those counts.
    """
    counts = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cells = F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"), F.lit(mask(p, rules)).cast("long").alias("mask")) for p in policies for r in rules if r.name in p.rules])
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        counts.select("fail_bits", "n", F.inline(cells))
        .groupBy("policy", "version", "rule")
        .agg(
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(failed == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        )
    )


def keep_documents(docs: DataFrame, policy: Policy = POLICIES[-1], rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents whose bits in the ledger pass ``policy``, with the columns that came in."""
    names = [fresh(docs, f"rule_{m}") for m in MEASURES]
    measured = with_kernel(docs, measure, [(n, T.LongType()) for n in names], text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    led = measured.select(row, *[F.col(n).alias(m) for n, m in zip(names, MEASURES, strict=True)]).withColumn("fail_bits", fail_bits(rules))
    return led.filter(passes(policy, F.col("fail_bits"), rules)).select("row.*")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents, with the verdict of the latest policy."""
    led = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    bits = F.col("fail_bits")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes(BASE, bits)).alias("base_failed"), passes(POLICIES[-1], bits).alias("kept"), "fail_bits")


def rule_ablation(spark, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects alone and with others, from the written ledger: no text is read twice."""
    led = Scratch(spark).table(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("fail_bits"))
    return ablation(led)


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LEDGER_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, * FROM documents),
base AS (
  SELECT row_id, doc_id, coalesce(text, '') AS t, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d),
grams AS (
  SELECT row_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM base)),
twice AS (SELECT row_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY row_id, a, b, c) > 1),
covered AS (SELECT row_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) s(o) GROUP BY row_id),
m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks, base.*
  FROM base LEFT JOIN covered USING (row_id)),
ledger AS (SELECT m.*, {" + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)} AS fail_bits FROM m)
"""
ORACLE = (
    LEDGER_SQL
    + f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & {mask(BASE)}) <> 0 AS base_failed, (fail_bits & {mask(POLICIES[-1])}) = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits
FROM ledger"""
)
_CELLS = ", ".join(f"('{p.name}', {p.version}, '{r.name}', {1 << r.bit}, {mask(p)})" for p in POLICIES for r in RULES if r.name in p.rules)
ABLATION_ORACLE = (
    LEDGER_SQL
    + f"""SELECT policy, version, rule, count(*) FILTER (fail_bits & bit <> 0) AS n_fail, count(*) FILTER (fail_bits & mask = bit) AS n_only, count(*) FILTER (fail_bits & mask = 0) AS n_kept
FROM ledger, (VALUES {_CELLS}) c(policy, version, rule, bit, mask) GROUP BY ALL"""
)

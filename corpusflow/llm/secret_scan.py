"""Secret scan: patterns, and character Markov models of random strings and ordinary identifiers.

All in DataFrame functions.  Three fixed patterns give the base spans.  What they cover is blanked; in the
rest every maximal run of 20 or more key characters, and every part of 20 or more between separators of a
run that is not taken whole, is judged by two first-order Markov models of its characters, one learned from
random strings, one from ordinary identifiers (``secret_samples``, labelled): where the log-likelihood ratio
is ``LEAST_RATIO`` hundredths a step or more it is a span of kind ``random``.  So UUIDs, digests, paths and
names are left alone, and what stands beside a base span is judged, too.  The ratios reach Spark as a literal
array of integers, so sums are exact.

The work grows with the text's length, however long its runs and however many its matches: characters are
numbered by splitting windows of a run, positions come from running sums, overlaps from running maxima
(``arrays``).  Positions are in code points, ends exclusive.  Defined results: a null or empty text has no
span; texts are scanned whole; spans that start together are in the order of the kinds; repeated rows give
repeated rows; an empty table gives no row; extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import secret_samples
from corpusflow.llm.arrays import let, replaced, running
from corpusflow.llm.arrow import fresh

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_=-]{20,}"
PART = "[A-Za-z0-9+]{20,}"
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = 3
LEAST_SECRET = 6
#: Hundredths a step, above all but a few of the held-out ordinary strings and below all but a few of the random ones.
LEAST_RATIO = 30
#: How often a string written by hand counts against one made up.
HAND_WEIGHT = 20
#: Characters of the models, which are those of ``RUN``.
ALPHABET = string.digits + string.ascii_lowercase + string.ascii_uppercase + "_-+/="
#: Steps of a run that are numbered at a time.
STEPS = 512


def train(noise: list[tuple[str, int]], names: list[tuple[str, int]]) -> list[int]:
    """The log-likelihood ratio of each step from one character to the next, in hundredths, from (string, weight)."""
    place = {c: i for i, c in enumerate(ALPHABET)}
    n = len(ALPHABET)

    def model(texts: list[tuple[str, int]]) -> list[list[float]]:
        counts = [[0.5] * n for _ in range(n)]
        for t, weight in texts:
            known = [place[c] for c in t if c in place]
            for a, b in zip(known, known[1:], strict=False):
                counts[a][b] += weight
        return [[c / sum(row) for c in row] for row in counts]

    p, q = model(noise), model(names)
    return [round(100 * math.log(p[i][j] / q[i][j])) for i in range(n) for j in range(n)]


def learned() -> list[int]:
    """The table of ratios, from the part of the labelled strings that is not held out."""
    first = lambda strings: secret_samples.split(strings)[0]
    return train([(s, 1) for s in first(secret_samples.drawn())], [(s, HAND_WEIGHT) for s in first(secret_samples.ORDINARY)] + [(s, 1) for s in first(secret_samples.made_up())])


TABLE = learned()


def ratio(run: str, table: list[int] = TABLE) -> int:
    """The plain-Python twin of ``ratio_of``."""
    place = [ALPHABET.index(c) for c in run]
    return sum(table[a * len(ALPHABET) + b] for a, b in zip(place, place[1:], strict=False))


def _numbers(values: list[int]) -> Column:
    """A literal array, written as text so that the plan holds one node for it."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def ratio_of(run: Column, table: list[int] = TABLE) -> Column:
    """The sum of the ratios of a run's steps; the run is read in windows that overlap by a character."""
    place, ratios, n = _numbers([max(ALPHABET.find(chr(c)), 0) for c in range(128)]), _numbers(table), len(ALPHABET)
    windows = F.regexp_extract_all(run, F.lit(f"(?=(.{{1,{STEPS + 1}}})).{{1,{STEPS}}}"), F.lit(1))
    steps = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: F.get(ratios, a * n + b))
    part = lambda w: let(F.transform(F.split(w, ""), lambda c: F.get(place, F.ascii(c))), lambda c: F.reduce(steps(c), F.lit(0), lambda a, x: a + x))
    return F.reduce(windows, F.lit(0), lambda a, w: a + part(w))


def _random(run: Column) -> Column:
    return ratio_of(run) >= LEAST_RATIO * (F.length(run) - 1)


def _places(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans (start, kind, end) of the matches for which ``keep`` (match) holds: each starts where the texts between and the matches before it end."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of(found: Column) -> Column:
        sizes = F.zip_with(F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length), found, lambda gap, m: gap + F.length(m))
        spans = lambda ends: F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), (keep(m) if keep else F.lit(True)).alias("kept")))
        kept = F.filter(let(running(sizes, lambda x, y: x + y), spans), lambda x: x["kept"])
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)).otherwise(none)


def base_spans(text: Column) -> Column:
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= LEAST_SECRET
    return F.array_sort(F.concat(_places(text, ASSIGN, 0, long_enough), _places(text, ACCESS, 1), _places(text, HEX, 2)))


def random_spans(text: Column) -> Column:
    """Runs that are taken whole, and parts of the others; ``text`` is the text without what base spans cover."""
    runs, parts = _places(text, RUN, 3, _random), _places(text, PART, 4, _random)

    def apart(every: Column) -> Column:
        covered = running(F.transform(every, lambda x: F.when(x["kind"] == 3, x["end"]).otherwise(0)), F.greatest)
        return let(covered, lambda ends: F.filter(every, lambda x, i: (x["kind"] == 3) | (x["start"] >= F.get(ends, i))))

    kept = F.when(F.size(parts) > 0, let(F.array_sort(F.concat(runs, parts)), apart)).otherwise(runs)
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))


def with_spans(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` and a column ``name``: array<struct(start, kind, end)>, kind by number, in span order."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))

    def both(base: Column) -> Column:
        free = F.when(F.size(base) > 0, replaced(whole, base, lambda n: F.repeat(F.lit(" "), n))).otherwise(whole)
        return F.array_sort(F.concat(base, let(free, random_spans)))

    return docs.withColumn(name, let(base_spans(whole), both))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` of every text."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    return with_spans(slim, "spans", "__text").select(F.col("__key").alias(key), "spans")


def redact(docs: DataFrame, mark: str = "<SECRET>", text: str = "text") -> DataFrame:
    """``docs`` with each span, overlapping and touching ones taken together, replaced by ``mark``; the texts of others stay."""
    name = fresh(docs, "secret_spans")
    made = with_spans(docs, name, text)
    clean = replaced(F.col(f"`{text}`"), F.col(name), lambda n: F.lit(mark))
    return made.select(*[(clean.alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns])


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document, as spans and counts."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = written(F.filter("spans", lambda x: x["kind"] < BASE_KINDS))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(base, 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _oracle() -> str:
    n = len(ALPHABET)
    place = lambda i: f"(instr({_quoted(ALPHABET)}, substr(m, {i}, 1)) - 1)"

    def places(kind: int, pattern: str, source: str) -> str:
        return f"""SELECT r, {kind} AS kind, regexp_extract_all(t, {_quoted(pattern)}) AS ms, string_split_regex(t, {_quoted(pattern)}) AS gaps FROM {source} WHERE regexp_matches(t, {_quoted(pattern)})"""

    def placed(name: str, source: str) -> str:
        return f"""{name}_flat AS (SELECT r, kind, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap FROM {source}),
{name} AS (SELECT r, kind, m, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY k) AS e FROM {name}_flat))"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
fixed AS ({" UNION ALL ".join(places(k, p, "d") for k, p in enumerate((ASSIGN, ACCESS, HEX)))}),
{placed("met", "fixed")},
base AS (SELECT r, kind, s, e FROM met WHERE kind > 0 OR length(regexp_extract(m, {_quoted(ASSIGN)}, 2)) >= {LEAST_SECRET}),
edge AS (SELECT r, kind, s, e, coalesce(max(e) OVER (PARTITION BY r ORDER BY s, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM base),
blank AS (SELECT r, string_agg(substr(t, c + 1, greatest(s - c, 0)) || repeat(' ', greatest(e - greatest(s, c), 0)), '' ORDER BY s, kind) || substr(any_value(t), max(e) + 1) AS t FROM edge JOIN d USING (r) GROUP BY r),
free AS (SELECT r, coalesce(blank.t, d.t) AS t FROM d LEFT JOIN blank USING (r)),
judged AS ({places(3, RUN, "free")} UNION ALL {places(4, PART, "free")}),
{placed("run", "judged")},
tbl AS (SELECT {TABLE!r} AS tbl),
likely AS (SELECT r, kind, s, any_value(e) AS e FROM (SELECT r, kind, s, e, m, tbl[{place('i')} * {n} + {place('i + 1')} + 1] AS step FROM (SELECT *, unnest(range(1, length(m))) AS i FROM run), tbl)
  GROUP BY r, kind, s HAVING sum(step) >= {LEAST_RATIO} * (any_value(length(m)) - 1)),
spans AS (SELECT * FROM base UNION ALL SELECT r, 3, s, e FROM likely p WHERE kind = 3 OR NOT EXISTS (SELECT 1 FROM likely w WHERE w.r = p.r AND w.kind = 3 AND w.s <= p.s AND p.e <= w.e)),
named AS (SELECT r, kind, s, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || s || ':' || e AS x FROM spans),
agg AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    coalesce(string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3), '') AS base, string_agg(x, ',' ORDER BY s, kind) AS spans FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (r)"""


ORACLE = _oracle()

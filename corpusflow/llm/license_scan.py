"""Licence scan: normalised text compared with licence templates by the Dice coefficient of word bigrams.

All in DataFrame functions.  A text is lower-cased, everything but letters and digits becomes a space, line
ends too, so a wrapped notice or one inside a longer line is found.  The Dice coefficient is that of a
template's set of bigrams and the set of a window of the text that is as long as the template.  A window
starts at every bigram of the text that a template in question has.  Bounds keep the work small and lose nothing
of this:

* to reach the threshold t a window must share ``least_overlap`` bigrams with the template, as it is no larger
  than that, so a template is only in question for a text that holds so many of its bigrams somewhere;
* fewer bigrams than that of any template lack all of ``ANCHORS`` (``anchors_of`` picks words until this holds), so
  a text without one of these words has no match.

Windows for one place give their best template: the largest coefficient, then the longer template, then the
name that sorts first.  Of windows that overlap by half of the shorter one or more the best stays, the first
of equals.  Defined results: a null or empty text has no match; texts are scanned whole, and the work grows with the
text's length times the templates'; a notice that occurs twice matches twice; repeated rows give repeated rows; an
empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.arrays import let
from corpusflow.llm.license_texts import TEMPLATES

THRESHOLD = 0.8
#: Short words that are anchors rather than others of their length.
SHORT = ("cc", "cc0", "gnu", "mit", "mpl", "bsd")


def normalise(text: str) -> list[str]:
    """The words of a text; the same as ``words_of`` in Spark."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """In order, with repetitions."""
    w = normalise(text)
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def least_overlap(size: int, t: float = THRESHOLD) -> int:
    """Bigrams that a set must share with a template of ``size`` distinct ones to reach ``t``: o of t/2 (o + size) at least."""
    return int(-(-(round(1000 * t) * size) // (2000 - round(1000 * t))))


def anchors_of(templates=TEMPLATES, t: float = THRESHOLD) -> tuple[str, ...]:
    """Words such that whoever reaches ``t`` for a template has one: while a template has too many bigrams without any, the longer word that most such bigrams have."""
    anchors: set[str] = set()
    sets = [{tuple(g.split()) for g in bigrams(x)} for x in templates.values()]
    while True:
        free = [[g for g in grams if anchors.isdisjoint(g)] for grams in sets]
        lacking = [g for own, grams in zip(free, sets, strict=True) if len(own) >= least_overlap(len(grams), t) for g in own]
        if not lacking:
            return tuple(sorted(anchors))
        count = Counter(w for g in lacking for w in g)
        anchors.add(max(count, key=lambda w: (len(w) > 6, w in SHORT, len(w) > 4, count[w], w)))


ANCHORS = anchors_of()


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    n = F.size(words) - 1
    pairs = lambda n: F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n > 0, pairs(n)).otherwise(F.array().cast("array<string>"))


def _list(grams: list[str]) -> Column:
    return F.split(F.lit("|".join(grams)), r"\|")


def _literal(templates, t: float) -> Column:
    """array<struct(rank, long, need, grams)>; rank -k for the k-th name, so that the greatest is the first."""
    rows = []
    for k, key in enumerate(sorted(templates)):
        grams = bigrams(templates[key])
        own = sorted(set(grams))
        rows.append(F.struct(F.lit(-k).alias("rank"), F.lit(len(grams)).alias("long"), F.lit(least_overlap(len(own), t)).alias("need"), _list(own).alias("grams")))
    return F.array(*rows)


def _matches(grams: Column, templates, t: float) -> Column:
    """array<struct(dice, long, rank, start)> of the windows that stay, by start; ``grams`` in text order."""
    every = _list(sorted({g for x in templates.values() for g in bigrams(x)}))
    none = F.array().cast("array<struct<dice:double,long:int,rank:int,start:int>>")
    longest = max(len(bigrams(x)) for x in templates.values())

    def scored(asked: Column) -> Column:
        held = F.array_distinct(F.flatten(F.transform(asked, lambda x: x["grams"])))
        starts = let(F.array_intersect(held, grams), lambda h: F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(h, g), i)), lambda i: i.isNotNull()))

        def window(i: Column) -> Column:
            def one(x: Column) -> Column:
                dice = let(F.array_distinct(F.slice(grams, i + 1, x["long"])), lambda w: F.lit(2.0) * F.size(F.array_intersect(w, x["grams"])) / (F.size(w) + F.size(x["grams"])))
                return F.struct(dice.alias("dice"), x["long"].alias("long"), x["rank"].alias("rank"), i.alias("start"))

            return F.array_max(F.transform(asked, one))

        return F.filter(F.transform(starts, window), lambda m: m["dice"] >= t)

    def best(found: Column) -> Column:
        # one window a start, so no more than ``longest`` entries to either side can overlap
        value = lambda m: F.struct(m["dice"], m["long"], m["rank"], -m["start"])
        shared = lambda m, o: F.least(m["start"] + m["long"], o["start"] + o["long"]) - F.greatest(m["start"], o["start"])
        near = lambda i: F.slice(found, F.greatest(i + 1 - longest, F.lit(1)), F.lit(2 * longest + 1))
        return F.filter(found, lambda m, i: ~F.exists(near(i), lambda o: (value(o) > value(m)) & (2 * shared(m, o) >= F.least(m["long"], o["long"]))))

    def asked(present: Column) -> Column:
        return F.filter(_literal(templates, t), lambda x: (F.size(present) >= x["need"]) & (F.size(F.array_intersect(x["grams"], present)) >= x["need"]))

    found = let(let(F.array_intersect(every, grams), asked), lambda a: F.when(F.size(a) > 0, scored(a)).otherwise(none))
    return let(found, lambda m: F.when(F.size(m) > 1, best(m)).otherwise(m))


def scan(docs: DataFrame, templates=TEMPLATES, t: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``matches``: (start and end in words of the normalised text, license, form, dice), in text order."""
    anchors = ANCHORS if templates is TEMPLATES and t == THRESHOLD else anchors_of(templates, t)
    names = sorted(templates)
    license_, form = (_list([n[k] for n in names]) for k in (0, 1))
    none = F.array().cast("array<struct<start:int,end:int,license:string,form:string,dice:double>>")
    slim = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("__text"))
    one = lambda m: F.struct(m["start"].alias("start"), (m["start"] + m["long"] + 1).alias("end"), F.get(license_, -m["rank"]).alias("license"), F.get(form, -m["rank"]).alias("form"), m["dice"].alias("dice"))
    made = lambda words: let(bigrams_of(words), lambda g: F.transform(_matches(g, templates, t), one))
    return slim.select(key, F.coalesce(let(words_of(F.col("__text")), lambda w: F.when(F.arrays_overlap(w, _list(anchors)), made(w))), none).alias("matches"))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence notices of every document: how many, which licences, where and in which form, and the best Dice coefficient."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.transform("matches", lambda m: m["license"])
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["form"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("licenses"), F.array_join(spans, ",").alias("spans"), F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)), 6).alias("best_dice"))


def _oracle() -> str:
    rows = ", ".join(f"('{n[0]}', '{n[1]}', {-k}, {len(bigrams(TEMPLATES[n]))}, {least_overlap(len(set(bigrams(TEMPLATES[n]))))}, {sorted(set(bigrams(TEMPLATES[n])))!r})" for k, n in enumerate(sorted(TEMPLATES)))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
tpl(license, form, rank, long, need, own) AS (VALUES {rows}),
gram AS (SELECT license, form, unnest(own) AS g FROM tpl),
w AS (SELECT r, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM d),
b AS (SELECT r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS b FROM w WHERE len(w) > 1),
place AS (SELECT r, unnest(b) AS g, unnest(range(0, len(b))) AS i FROM b),
asked AS (SELECT r, license, form FROM (SELECT DISTINCT r, g FROM place) JOIN gram USING (g) JOIN tpl USING (license, form) GROUP BY r, license, form HAVING count(*) >= any_value(need)),
start AS (SELECT DISTINCT place.r, i FROM place JOIN gram USING (g) JOIN asked ON asked.r = place.r AND asked.license = gram.license AND asked.form = gram.form),
win AS (SELECT r, i, license, form, rank, long, own, list_distinct(b[i + 1 : i + long]) AS x FROM start JOIN asked USING (r) JOIN tpl USING (license, form) JOIN b USING (r)),
dice AS (SELECT r, i, license, form, rank, long, 2.0 * len(list_intersect(x, own)) / (len(x) + len(own)) AS dice FROM win),
best AS (SELECT * FROM dice WHERE dice >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY r, i ORDER BY dice DESC, long DESC, rank DESC) = 1),
hit AS (SELECT * FROM best m WHERE NOT EXISTS (SELECT 1 FROM best o WHERE o.r = m.r AND (o.dice, o.long, o.rank, -o.i) > (m.dice, m.long, m.rank, -m.i)
  AND 2 * (least(m.i + m.long, o.i + o.long) - greatest(m.i, o.i)) >= least(m.long, o.long))),
agg AS (SELECT r, count(*) AS n, array_to_string(list_sort(list_distinct(list(license))), ',') AS names,
  string_agg(license || ':' || form || ':' || i || ':' || (i + long + 1), ',' ORDER BY i) AS spans, max(dice) AS top FROM hit GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, coalesce(spans, '') AS spans, round(CAST(coalesce(top, 0) AS DOUBLE), 6) AS best_dice
FROM d LEFT JOIN agg USING (r)"""


ORACLE = _oracle()

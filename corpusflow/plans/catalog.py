"""All queries over the driver's tables, each by way of the library's operators, with their SQL twins.

The tables stand in for a speech corpus: documents for transcripts, events for timed words, orders and
line items for recordings and their chunks, customers and suppliers for speakers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import corpus as C
from corpusflow.operators import relational as R
from corpusflow.operators import sequences as S
from corpusflow.operators import splits as P
from corpusflow.session import tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` is the table of that name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        times = {c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"}
        return df.withColumns(times) if times else df


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def seconds_of(ts):
    return F.unix_micros(ts) / F.lit(1000000.0)


def licence_url():
    kinds = F.array(*map(F.lit, ("by/4.0", "by-sa/3.0", "publicdomain/zero", "government-works", "other")))
    return F.concat(F.lit("https://licences.example/"), F.get(kinds, (F.col("doc_id") % 5).cast("int")))


SQL_LICENCE = "'https://licences.example/' || ['by/4.0', 'by-sa/3.0', 'publicdomain/zero', 'government-works', 'other'][doc_id % 5 + 1]"
SQL_CLASS = """CASE WHEN url LIKE '%government-works%' THEN 'US Government Works' WHEN url LIKE '%publicdomain%' THEN 'Public Domain'
 WHEN url LIKE '%by-sa%' THEN 'CC BY-SA' WHEN url LIKE '%by%' THEN 'CC BY' ELSE 'Unknown' END"""
SQL_WORDS = r"list_filter(regexp_split_to_array(coalesce(lower(text), ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"


@query(f"""SELECT class, round(sum(n_chars) / 3600.0, 6) AS hours, count(*) AS n FROM (
 SELECT n_chars, {SQL_CLASS} AS class FROM (SELECT *, {SQL_LICENCE} AS url FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
   AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)) WHERE n_chars >= 100 AND n_chars < 15000) GROUP BY class""")
def flagship_hours(t):
    """Hours by licence class after hold-out and quality filters (a character stands for a second)."""
    docs = t.documents.select("doc_id", "text", "n_chars")
    kept = R.held_out(docs, ["doc_id"], t.labels.filter("toxic = 1")).filter("n_chars >= 100 AND n_chars < 15000")
    kept = R.held_out(kept, ["text"], t.benchmark)
    return R.hours_by(kept, X.licence_class(licence_url()), F.col("n_chars"), "class").select("class", F.round("hours", 6).alias("hours"), "n")


@query("""SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN customer c ON true WHERE l.l_orderkey = o.o_orderkey
 AND c.c_custkey = o.o_custkey AND l.l_returnflag = 'R') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def anti_duplicates(t):
    """Two-key and one-key anti joins before any heavy work."""
    pairs = t.lineitem.filter("l_returnflag = 'R'").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey")
    return R.held_out(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"], pairs).transform(lambda d: R.held_out(d, ["o_custkey"], t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))))


@query(f"SELECT doc_id, url FROM (SELECT doc_id, {SQL_LICENCE} AS url FROM documents) WHERE regexp_matches(url, 'by') AND NOT regexp_matches(url, 'by-sa')")
def licence_selection(t):
    """Licence address by pattern; negation drops nulls."""
    return t.documents.select("doc_id", licence_url().alias("url")).dropna(subset=["url"]).filter(F.col("url").rlike("by") & ~F.col("url").rlike("by-sa"))


@query("""SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 6) AS quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 40
 AND l_discount >= 0.02 AND l_discount < 0.08 GROUP BY l_orderkey""")
def nested_quality_filter(t):
    """Parallel arrays zipped, filtered inside the array, and folded."""
    soa = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_discount")).alias("rows")).select("l_orderkey", X.unzipped(F.array_sort("rows"), "l_linenumber", "l_quantity", "l_discount").alias("a"))
    aos = F.filter(X.zipped(F.col("a"), "l_quantity", "l_discount"), lambda x: (x["l_quantity"] >= 10) & (x["l_quantity"] < 40) & (x["l_discount"] >= 0.02) & (x["l_discount"] < 0.08))
    kept = soa.select("l_orderkey", aos.alias("kept")).filter(F.size("kept") > 0)
    return kept.select("l_orderkey", F.size("kept").cast("long").alias("n"), F.round(F.aggregate("kept", F.lit(0.0), lambda acc, x: acc + x["l_quantity"]), 6).alias("quantity"))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 10")
def top_languages(t):
    return t.documents.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(10)


@query("SELECT lang, round(sum(n_chars) / 3600.0, 6) AS hours, count(*) AS n FROM documents GROUP BY lang")
def hours_per_language(t):
    return R.hours_by(t.documents, F.col("lang"), F.col("n_chars"), "lang").select("lang", F.round("hours", 6).alias("hours"), "n")


@query("SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM events GROUP BY event_type")
def value_shares(t):
    return R.shares(t.events, "event_type").withColumn("share", F.round("share", 9))


@query("SELECT event_id, user_id FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE n > 10")
def frequent_users(t):
    return R.frequent(t.events, "user_id", 10).select("event_id", "user_id")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) <= 2")
def capped_repeats(t):
    """Two documents of each text at most."""
    return R.cap_repeats(t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest")), "digest", "doc_id", 2).select("doc_id")


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n,
 CAST(('0x' || substr(md5('thin/' || (l_orderkey * 10 + l_linenumber)), 1, 8)) AS BIGINT) / 4294967296.0 AS chance FROM lineitem) WHERE n <= 20 OR chance < 20.0 / n""")
def thinned_repeats(t):
    """Values above the cap kept with probability cap / n."""
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"))
    return R.thin_repeats(d, "l_partkey", "key", 20).select("l_orderkey", "l_linenumber")


@query("""WITH n AS (SELECT *, o_orderpriority || '-' || o_orderstatus || '-' || o_orderkey AS name FROM orders)
 SELECT a, b, distance FROM (SELECT x.o_orderkey AS a, y.o_orderkey AS b, levenshtein(x.name, y.name) AS distance FROM n x JOIN n y ON x.o_custkey = y.o_custkey AND x.o_orderkey % 2 = 0 AND y.o_orderkey % 2 = 1)
 QUALIFY row_number() OVER (PARTITION BY a ORDER BY distance, b) = 1""")
def nearest_names(t):
    """For an order the customer's other order with the nearest name (a customer stands for an item, with few files at any size)."""
    d = t.orders.select("o_orderkey", "o_custkey", F.concat_ws("-", "o_orderpriority", "o_orderstatus", "o_orderkey").alias("name"))
    x, y = d.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("a"), "o_custkey", F.col("name").alias("x")), d.filter("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("b"), "o_custkey", F.col("name").alias("y"))
    both = x.join(y, "o_custkey").select("a", "b", F.levenshtein("x", "y").cast("long").alias("distance"))
    return R.first_of(both, ["a"], ["distance", "b"])


@query()
def stable_matching(t):
    """Recordings and transcripts of an item matched one to one by name (greedy deferred acceptance: no SQL); a customer stands for an item."""
    from corpusflow.operators.alignment import match_documents

    d = t.orders.select(F.col("o_custkey").cast("string").alias("identifier"), F.concat_ws("-", "o_orderpriority", "o_orderstatus", "o_orderkey").alias("name"), "o_orderkey")
    a, b = d.filter("o_orderkey % 2 = 0").select("identifier", F.col("name").alias("audio_document_id")), d.filter("o_orderkey % 2 = 1").select("identifier", F.col("name").alias("text_document_id"))
    return match_documents(a, b)


@query("""SELECT event_id, user_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM (
 SELECT *, CASE WHEN epoch_us(ts) / 1000000.0 - lag(epoch_us(ts) / 1000000.0) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 86400 THEN 1 ELSE 0 END AS new FROM events)""")
def sessions(t):
    e = t.events.withColumn("start", seconds_of(F.col("ts"))).withColumn("end", F.col("start"))
    return S.sessions(e, "user_id", "start", "end", 86400, "event_id").select("event_id", "user_id", F.col("session").cast("long").alias("session"))


@query("""WITH RECURSIVE w AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(floor(value) AS BIGINT) AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
 f AS (SELECT user_id, rn, e, s AS open_at, 1 AS frag FROM w WHERE rn = 1 UNION ALL
  SELECT w.user_id, w.rn, w.e, CASE WHEN w.e - f.open_at > 864000000 OR w.s - f.e > 172800000 THEN w.s ELSE f.open_at END,
   CASE WHEN w.e - f.open_at > 864000000 OR w.s - f.e > 172800000 THEN f.frag + 1 ELSE f.frag END FROM f JOIN w ON w.user_id = f.user_id AND w.rn = f.rn + 1)
 SELECT user_id, CAST(any_value(open_at) AS BIGINT) AS start, CAST(arg_max(e, rn) AS BIGINT) AS "end", count(*) AS n FROM f GROUP BY user_id, frag""")
def bounded_fragments(t):
    """Events joined into fragments of bounded length and silence, by a fold over each user's events."""
    word = F.struct(F.unix_millis("ts").alias("start_ms"), "event_id", (F.unix_millis("ts") + F.floor("value")).alias("end_ms"), F.col("event_id").cast("string").alias("word"))
    per = t.events.groupBy("user_id").agg(F.array_sort(F.collect_list(word)).alias("words"))
    out = per.select("user_id", F.explode(S.fragments(F.col("words"), 864_000_000, 172_800_000)).alias("f"))
    return out.select("user_id", "f.start", "f.end", F.size(F.split("f.transcript", " ")).cast("long").alias("n"))


@query("""WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS a, epoch_us(ts) / 1000000.0 + value AS b FROM events),
 p AS (SELECT *, greatest(0.0, a - 5.0) AS s, least(b + 5.0, max(b) OVER (PARTITION BY user_id) + 1.0) AS e FROM s),
 n AS (SELECT *, lag(e) OVER w AS pe, lead(s) OVER w AS ns FROM p WINDOW w AS (PARTITION BY user_id ORDER BY (a + b) / 2, event_id)),
 x AS (SELECT user_id, event_id, CASE WHEN pe > s THEN (pe + s) / 2 ELSE s END AS s, CASE WHEN ns < e THEN (ns + e) / 2 ELSE e END AS e FROM n)
 SELECT event_id, round(s, 3) AS start, round(e, 3) AS "end" FROM x WHERE s < e""")
def extended_segments(t):
    s = t.events.select("user_id", "event_id", seconds_of(F.col("ts")).alias("start"), (seconds_of(F.col("ts")) + F.col("value")).alias("end"))
    return S.extended(s, 5.0, 5.0, 1.0, "user_id", "event_id").select("event_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query("""SELECT doc_id, i AS part, CAST(i * 25.0 AS DOUBLE) AS start, CASE WHEN i = n THEN d ELSE least(d, i * 25.0 + 30) END AS "end" FROM (
 SELECT doc_id, d, n, unnest(range(0, n + 1)) AS i FROM (SELECT doc_id, n_chars / 20.0 AS d, greatest(0, CAST(ceil((n_chars / 20.0 - 40) / 25.0) AS INT)) AS n FROM documents))""")
def uniform_windows(t):
    d = t.documents.select("doc_id", F.posexplode(S.uniform_windows(F.col("n_chars") / 20.0)).alias("part", "w"))
    return d.select("doc_id", F.col("part").cast("long").alias("part"), "w.start", "w.end")


@query(f"""WITH w AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents), s AS (SELECT *, CAST(floor(len(w) / 100) AS INT) + 1 AS docs FROM w),
 k AS (SELECT *, CAST(floor(len(w) / docs) AS INT) + 1 AS shift FROM s), p AS (SELECT doc_id, w, shift, unnest(range(0, docs)) AS i FROM k)
 SELECT doc_id, i AS part, md5(array_to_string(w[i * shift + 1 : (i + 1) * shift], ' ')) AS digest FROM p WHERE len(w) > i * shift""")
def split_documents(t):
    """Texts as documents of at most 100 words."""
    w = t.documents.select("doc_id", X.words(F.lower("text")).alias("words"))
    return w.select("doc_id", F.posexplode(S.split_documents(F.col("words"), 100)).alias("part", "w")).select("doc_id", F.col("part").cast("long").alias("part"), F.md5(F.array_join("w", " ").cast("binary")).alias("digest"))


@query("""WITH d AS (SELECT d.doc_id, d.source, coalesce(l.quality, 0) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)),
 c AS (SELECT floor(avg(n) + 0.5 * stddev_pop(n)) AS cap FROM (SELECT count(*) AS n FROM d GROUP BY source))
 SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quality DESC, doc_id DESC) AS rn FROM d), c WHERE rn <= cap""")
def debiased(t):
    d = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(0)))
    return P.debiased(d, "source", "quality", "doc_id", 0.5).select("doc_id", "source")


@query("""SELECT c_custkey, CASE WHEN rn <= 20 THEN 'test' WHEN rn <= 50 THEN 'dev' ELSE 'train' END AS split FROM (SELECT c_custkey, row_number() OVER (ORDER BY md5('42/' || c_custkey), c_custkey) AS rn FROM customer)""")
def random_split(t):
    return P.random_split(t.customer.select("c_custkey"), "c_custkey", 20, 30)


@query("""WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), c AS (SELECT o_custkey, sum(n) OVER (ORDER BY n, o_custkey ROWS UNBOUNDED PRECEDING) AS cum FROM s)
 SELECT o_orderkey, CASE WHEN cum <= 100 THEN 'test' WHEN cum <= 300 THEN 'dev' ELSE 'train' END AS split FROM orders JOIN c USING (o_custkey)""")
def entity_split(t):
    """Orders split by customer: no customer in two parts."""
    return P.entity_split(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 100, 200).select("o_orderkey", "split")


@query("""WITH s AS (SELECT c_nationkey, row_number() OVER (ORDER BY md5('42/' || c_nationkey), c_nationkey) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT c_nationkey FROM customer))
 SELECT c_custkey, CASE WHEN rn <= least(5, n - 1) THEN 'test' ELSE 'train' END AS split FROM customer JOIN s USING (c_nationkey)""")
def speaker_split(t):
    return P.speaker_split(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", 5).select("c_custkey", "split")


@query("""SELECT c_custkey, CASE WHEN c_acctbal >= 8000 THEN 'gold' WHEN c_acctbal >= 4000 THEN 'silver' ELSE 'other' END AS part FROM customer""")
def quality_parts(t):
    return t.customer.select("c_custkey", P.quality_part(F.col("c_acctbal"), [(4000, "silver"), (8000, "gold")], "other").alias("part"))


@query("""SELECT year, round(seconds, 2) AS seconds, round(sum(seconds) OVER (ORDER BY year) / 3600.0, 4) AS cumulative_hours FROM (SELECT year(o_orderdate) AS year, sum(o_totalprice) AS seconds FROM orders GROUP BY 1)""")
def yearly_cumulative(t):
    return S.yearly_cumulative(t.orders, F.col("o_orderdate"), F.col("o_totalprice")).select(F.col("year").cast("long").alias("year"), F.round("seconds", 2).alias("seconds"), F.round("cumulative_hours", 4).alias("cumulative_hours"))


@query("""WITH c AS (SELECT l_quantity AS v, sum(l_quantity) AS m FROM lineitem GROUP BY 1), r AS (SELECT v, sum(m) OVER (ORDER BY v) / sum(m) OVER () AS up, sum(m) OVER (ORDER BY v DESC) / sum(m) OVER () AS down FROM c)
 SELECT greatest(0.3, min(v) FILTER (up > 0.05)) AS low, max(v) FILTER (down > 0.05) AS high FROM r""")
def coverage_range(t):
    return S.coverage_range(t.lineitem, "l_quantity")


_SQL_TERMS = f"t AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({SQL_WORDS}) AS term FROM documents) GROUP BY ALL)"


@query(f"""WITH {_SQL_TERMS}, n AS (SELECT count(*) AS docs FROM documents), w AS (SELECT term, count(*) AS with_term FROM t GROUP BY term)
 SELECT doc_id, count(*) AS terms, round(sum(t.n * ln(docs / with_term)), 4) AS weight FROM t JOIN w USING (term), n GROUP BY doc_id""")
def tf_idf(t):
    """Total TF-IDF weight of each document."""
    w = C.tf_idf(t.documents, "doc_id", "text")
    return w.groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.sum("weight"), 4).alias("weight"))


@query(f"""WITH {_SQL_TERMS}, n AS (SELECT count(*) AS docs FROM documents), w AS (SELECT term, count(*) AS with_term FROM t GROUP BY term),
 s AS (SELECT doc_id, term, t.n * ln(docs / with_term) AS weight FROM t JOIN w USING (term), n),
 q AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({SQL_WORDS}) AS term FROM benchmark) GROUP BY ALL),
 d AS (SELECT item_id, doc_id, sum(q.n * weight) AS score FROM q JOIN s USING (term) GROUP BY ALL)
 SELECT item_id, doc_id, round(score, 4) AS score FROM d QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) <= 3""")
def similar_documents(t):
    """For each benchmark item the three documents with the largest TF-IDF dot product."""
    q = C.term_counts(t.benchmark, "item_id", "text").select("item_id", "term", F.col("n").cast("double").alias("weight"))
    return C.most_similar(q, C.tf_idf(t.documents, "doc_id", "text", only=q), "item_id", "doc_id", 3).select("item_id", "doc_id", F.round("score", 4).alias("score"))


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT 50")
def top_vocabulary(t):
    return C.vocabulary(t.documents, "text", 50).select("word", "n")


@query(f"""WITH w AS (SELECT unnest(list_append({SQL_WORDS.replace('lower(text)', 'text')}, '</s>')) AS word FROM documents)
 SELECT word, n, round(-ln(n / sum(n) OVER ()), 6) AS cost FROM (SELECT word, count(*) AS n FROM w GROUP BY word)""")
def unigram_costs(t):
    return C.unigram_costs(t.documents, "text").withColumn("cost", F.round("cost", 6))


@query(f"""WITH w AS (SELECT list_concat(['<s>'], {SQL_WORDS}, ['</s>']) AS w FROM documents), g AS (SELECT w[i] AS h, w[i + 1] AS word FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w)),
 b AS (SELECT h, word, count(*) AS c FROM g GROUP BY ALL) SELECT CAST(2 AS BIGINT) AS "order", count(*) AS grams, sum(c)::BIGINT AS mass, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2 FROM b
 UNION ALL SELECT 1, count(*), sum(c)::BIGINT, count(*) FILTER (c = 1), count(*) FILTER (c = 2) FROM (SELECT word, count(*) AS c FROM b GROUP BY word)""")
def kn_counts(t):
    """Kneser-Ney counts of two orders, summed up."""
    c = C.kn_counts(t.documents, "text")
    return c.groupBy(F.col("order").cast("long").alias("order")).agg(F.count("*").alias("grams"), F.sum("c").alias("mass"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"))


@query(f"""WITH w AS (SELECT list_concat(['<s>'], {SQL_WORDS}, ['</s>']) AS w FROM documents), g AS (SELECT w[i] AS h, w[i + 1] AS word FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w)),
 b AS (SELECT h, word, count(*) AS c FROM g GROUP BY ALL), u AS (SELECT word, count(*) AS c FROM b GROUP BY word),
 d AS (SELECT count(*) FILTER (c = 1) / greatest(1, count(*) FILTER (c = 1) + 2 * count(*) FILTER (c = 2)) AS d FROM b), p AS (SELECT word, c / sum(c) OVER () AS p1 FROM u),
 x AS (SELECT h, word, greatest(0, c - d) / sum(c) OVER (PARTITION BY h) + d * count(*) OVER (PARTITION BY h) / sum(c) OVER (PARTITION BY h) * p1 AS p FROM b JOIN p USING (word), d)
 SELECT h AS history, count(*) AS words, CAST(floor(sum(p) * 10000 + 0.4137) AS BIGINT) AS mass, CAST(floor(max(p) * 1000000 + 0.4137) AS BIGINT) AS most FROM x GROUP BY h""")
def kn_bigrams(t):
    """Interpolated Kneser-Ney bigram probabilities of the documents, summed up by history (ten-thousandths and millionths)."""
    per = C.interpolated_sums(t.documents, "text")
    return per.select("history", "words", F.floor(F.col("mass") * 10000 + 0.4137).alias("mass"), F.floor(F.col("most") * 1000000 + 0.4137).alias("most"))


@query(f"""WITH {_SQL_TERMS}, l AS (SELECT doc_id, sum(n) AS length FROM t GROUP BY doc_id), a AS (SELECT count(*) AS docs, avg(length) AS mean FROM l), w AS (SELECT term, count(*) AS with_term FROM t GROUP BY term),
 q AS (SELECT DISTINCT item_id, unnest({SQL_WORDS}) AS term FROM benchmark),
 s AS (SELECT item_id, doc_id, round(sum(ln(1 + (docs - with_term + 0.5) / (with_term + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN l USING (doc_id), a GROUP BY ALL)
 SELECT item_id, doc_id, round(score, 4) AS score FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 5""")
def bm25_search(t):
    return C.bm25(t.benchmark, t.documents, "item_id", "text", "doc_id", "text", 5).select("item_id", "doc_id", F.round("score", 4).alias("score"))


_OPS = """SELECT o_orderpriority AS speaker, o_orderkey % 7 AS c, o_orderkey % 3 AS s, o_custkey % 2 AS i, o_custkey % 3 AS d FROM orders"""


@query(f"""WITH o AS ({_OPS}), g AS (SELECT coalesce(speaker, 'SUM') AS speaker, count(*) AS sent, sum(c)::BIGINT AS c, sum(s)::BIGINT AS s, sum(i)::BIGINT AS i, sum(d)::BIGINT AS d, count(*) FILTER (s + i + d > 0) AS bad FROM o GROUP BY ROLLUP (speaker))
 SELECT speaker, sent, c + s + d AS words, c, s, i, d, round(100.0 * c / (c + s + d), 6) AS corr, round(100.0 * (s + i + d) / (c + s + d), 6) AS err, round(100.0 * bad / sent, 6) AS s_err FROM g""")
def speaker_table(t):
    """Word error rates by speaker with an overall row."""
    o = t.orders.selectExpr("o_orderpriority AS speaker", "o_orderkey % 7 AS c", "o_orderkey % 3 AS s", "o_custkey % 2 AS i", "o_custkey % 3 AS d")
    return C.speaker_table(o).select("speaker", "sent", "words", "c", "s", "i", "d", *[F.round(x, 6).alias(x) for x in ("corr", "err", "s_err")])


@query("""SELECT CASE WHEN ref IS NULL THEN 'insertion' WHEN hyp IS NULL THEN 'deletion' WHEN ref = hyp THEN 'correct' ELSE 'substitution' END AS operation, ref, hyp, count(*) AS n
 FROM (SELECT CASE WHEN l_linenumber % 5 > 0 THEN l_returnflag END AS ref, CASE WHEN l_linenumber % 4 > 0 THEN l_linestatus END AS hyp FROM lineitem) GROUP BY ALL""")
def confusion_counts(t):
    return C.confusions(t.lineitem.selectExpr("CASE WHEN l_linenumber % 5 > 0 THEN l_returnflag END AS ref", "CASE WHEN l_linenumber % 4 > 0 THEN l_linestatus END AS hyp"))


@query("SELECT round(100.0 * sum(l_linenumber) / sum(l_quantity), 6) AS rate FROM lineitem")
def micro_error_rate(t):
    return C.micro_rate(t.lineitem, "l_linenumber", "l_quantity").select(F.round("rate", 6).alias("rate"))


@query()
def html_texts(t):
    """Text of web pages (the pieces of markup are cut by look-ahead patterns that SQL's engine lacks)."""
    return t.pages.select("page_id", "url", X.html_text(F.col("html")).alias("text"))


@query("SELECT event_id, props AS json, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events")
def json_properties(t):
    m = X.as_map(F.col("props"))
    return t.events.select("event_id", F.col("props").alias("json"), F.get(F.map_values(m), F.lit(0)).alias("first_value"))


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS joined FROM conversations GROUP BY conv_id")
def conversation_texts(t):
    return R.collected(t.conversations, "conv_id", "text", ["turn"])


_INTERVALS = "SELECT l_suppkey * 100 + l_linenumber AS file, l_orderkey, l_linenumber, epoch(l_shipdate) / 86400.0 AS a, epoch(l_shipdate) / 86400.0 + l_quantity AS b FROM lineitem WHERE l_returnflag"


@query(f"""WITH h AS ({_INTERVALS} = 'R'), r AS ({_INTERVALS} = 'A'),
 f AS (SELECT h.file, sum(least(h.b, r.b) - greatest(h.a, r.a)) AS found FROM h JOIN r ON h.file = r.file AND h.a < r.b AND r.a < h.b GROUP BY h.file),
 o AS (SELECT file, sum(b - a) AS hyp, count(*) FILTER (b - a < 2) AS n_short, count(*) FILTER (b - a > 45) AS n_long FROM h GROUP BY file)
 SELECT file, round(hyp, 4) AS hypothesised, round(coalesce(found, 0), 4) AS found, n_short, n_long FROM o LEFT JOIN f USING (file)""")
def interval_overlap(t):
    """Overlap of two sets of intervals by file."""
    i = t.lineitem.select((F.col("l_suppkey") * 100 + F.col("l_linenumber")).alias("file"), "l_orderkey", "l_returnflag", (F.unix_seconds("l_shipdate") / 86400.0).alias("start"), (F.unix_seconds("l_shipdate") / 86400.0 + F.col("l_quantity")).alias("end"))
    hyp, ref = i.filter("l_returnflag = 'R'"), i.filter("l_returnflag = 'A'")
    return R.segmentation_scores(hyp, ref, "file", 2, 45).select("file", F.round("hypothesised", 4).alias("hypothesised"), F.round("found", 4).alias("found"), "n_short", "n_long")


@query("SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 200000.0::DOUBLE WHEN o_totalprice >= 100000 THEN 100000.0::DOUBLE WHEN o_totalprice >= 50000 THEN 50000.0::DOUBLE END AS below, CASE WHEN o_totalprice <= 50000 THEN 50000.0::DOUBLE WHEN o_totalprice <= 100000 THEN 100000.0::DOUBLE WHEN o_totalprice <= 200000 THEN 200000.0::DOUBLE END AS above FROM orders")
def nearest_bucket(t):
    """The bounds on either side of a value."""
    return t.orders.select("o_orderkey", R.bucket_of(F.col("o_totalprice"), [50000, 100000, 200000]).alias("b")).select("o_orderkey", "b.below", "b.above")


@query("SELECT c_custkey, list_transform(string_split(c_mktsegment, ''), lambda x: CASE WHEN x = 'A' THEN '1' WHEN x = 'E' THEN '2' ELSE '<UNK>' END)[1] AS first_token, len(string_split(c_mktsegment, '')) AS n FROM customer")
def mapped_tokens(t):
    """Characters of a word mapped through a table."""
    table = t.spark.createDataFrame([("A", "1"), ("E", "2")], "token string, to string")
    d = t.customer.select("c_custkey", X.spelled(F.col("c_mktsegment")).alias("tokens"))
    return R.map_tokens(d, "c_custkey", "tokens", table, "<UNK>").select("c_custkey", F.get("tokens", F.lit(0)).alias("first_token"), F.size("tokens").cast("long").alias("n"))


@query("""WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS s, epoch_us(ts) / 1000000.0 + value * 1000 AS e FROM events)
 SELECT event_id, round(greatest(0, coalesce(e - lead(s) OVER (PARTITION BY user_id ORDER BY s, e, event_id), 0)), 3) AS overlap FROM s""")
def adjacent_overlaps(t):
    s = t.events.select("user_id", "event_id", seconds_of(F.col("ts")).alias("start"), (seconds_of(F.col("ts")) + F.col("value") * 1000).alias("end"))
    return S.adjacent_overlap(s, "user_id", "event_id").select("event_id", F.round("overlap", 3).alias("overlap"))


@query("""SELECT a.user_id, a.event_id, b.event_id AS other FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) a
 JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS p FROM events) b ON a.user_id = b.user_id AND a.p = b.p""")
def joined_by_position(t):
    a = t.events.select("user_id", "event_id", F.struct("ts", "event_id").alias("o1"))
    b = t.events.select("user_id", F.col("event_id").alias("other"), F.struct("value", "event_id").alias("o2"))
    return R.by_position(a, b, "user_id", "o1", "o2").select("user_id", "event_id", "other")


@query("SELECT n AS shard, count(*) AS rows FROM (SELECT floor((row_number() OVER (ORDER BY p_partkey) - 1) / 335) AS n FROM part) GROUP BY n")
def archive_shards(t):
    return R.chunked(t.part.select("p_partkey"), ["p_partkey"], 335).groupBy(F.col("shard").cast("double").alias("shard")).agg(F.count("*").alias("rows"))


@query("SELECT s_suppkey, (row_number() OVER (ORDER BY s_suppkey) - 1) % 4 AS split FROM supplier")
def round_robin(t):
    return R.round_robin(t.supplier.select("s_suppkey"), ["s_suppkey"], 4).select("s_suppkey", F.col("split").cast("long").alias("split"))


@query("""WITH k AS (SELECT page_id, replace(replace(replace(url || '/' || url, '/', '_SLASH_'), '.', '_DOT_'), ' ', '_SPACE_') AS k FROM pages)
 SELECT page_id, CASE WHEN length(k) < 100 THEN k ELSE substr(k, 1, 36) || sha256(k) END AS key FROM k""")
def file_keys(t):
    return t.pages.select("page_id", X.file_key(F.concat_ws("/", "url", "url"), 100, 36).alias("key"))


@query("""WITH f AS (SELECT 'l_quantity' AS metric, l_quantity AS v, l_extendedprice AS w FROM lineitem UNION ALL SELECT 'l_tax', l_tax * 100, l_extendedprice FROM lineitem)
 SELECT metric, CASE WHEN v > 40 THEN '>40' ELSE CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) END AS bucket, count(*) AS n, round(sum(w), 2) AS total FROM f GROUP BY ALL""")
def bucketed_statistics(t):
    """Histograms of several measures in one pass."""
    d = t.lineitem.select("l_quantity", (F.col("l_tax") * 100).alias("l_tax"), "l_extendedprice")
    return R.bucketed(d, ["l_quantity", "l_tax"], "l_extendedprice", 40).withColumn("total", F.round("total", 2))


@query("""SELECT (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS without_items,
 (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) AS repeated_keys, (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS consistent""")
def data_consistency(t):
    """Keys that every table has, and keys met twice."""
    o, l = t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber")
    kept = R.consistent(o, l, on="k")[0].agg(F.count("*").alias("consistent"))
    missing = R.by_ids(o, l.select("k"), "k", exclude=True).agg(F.count("*").alias("without_items"))
    twice = l.groupBy("k", "l_linenumber").count().filter("count > 1").agg(F.count("*").alias("repeated_keys"))
    return missing.crossJoin(twice).crossJoin(kept)  # one row each


@query("""SELECT user_id, event_type, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events) GROUP BY user_id, event_type, g""")
def label_runs(t):
    """Maximal runs of one event type."""
    return S.runs(t.events.withColumn("o", F.struct(F.unix_micros("ts").alias("us"), "event_id")), "user_id", "o", "event_type").select("user_id", "event_type", F.col("first.us").alias("first"), F.col("last.us").alias("last"), "n")


@query("""WITH t AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) SELECT l_suppkey, l_returnflag, q AS total FROM t QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC, l_returnflag) = 1""")
def dominant_member(t):
    return R.dominant(t.lineitem, "l_suppkey", "l_returnflag", "l_quantity")


@query("""WITH h AS (SELECT l_returnflag, l_quantity AS v, count(*) AS n FROM lineitem GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY v) AS cum, sum(n) OVER (PARTITION BY l_returnflag) AS total FROM h)
 SELECT l_returnflag, min(v) FILTER (cum >= floor(0.05 * total)) AS p5, min(v) FILTER (cum >= floor(0.5 * total)) AS p50, min(v) FILTER (cum >= floor(0.95 * total)) AS p95 FROM c GROUP BY l_returnflag""")
def histogram_percentiles(t):
    h = t.lineitem.groupBy("l_returnflag", "l_quantity").agg(F.count("*").alias("n"))
    return R.histogram_percentiles(h, "l_quantity", "n", [0.05, 0.5, 0.95], ["l_returnflag"])


@query("SELECT round(sum(value), 4) AS total, round(avg(value), 6) AS mean, (SELECT event_id FROM events ORDER BY value DESC, event_id LIMIT 1) AS longest, (SELECT event_id FROM events ORDER BY value, event_id LIMIT 1) AS shortest FROM events")
def segment_extremes(t):
    return R.extremes(t.events, "event_id", F.col("value")).select(F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), "longest", "shortest")


@query("SELECT word, pron, round(n / max(n) OVER (PARTITION BY word), 6) AS prob FROM (SELECT p_brand AS word, p_type AS pron, count(*) AS n FROM part GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, pron) <= 2")
def top_pronunciations(t):
    prons = t.part.groupBy(F.col("p_brand").alias("word"), F.col("p_type").alias("pron")).agg(F.count("*").alias("n"))
    return C.top_prons(C.normalised_prons(prons), 2).select("word", "pron", F.round("prob", 6).alias("prob"))


@query("""WITH s AS (SELECT l_orderkey AS utt, l_returnflag AS word, l_linestatus AS pron, sum(l_quantity) AS post, min(epoch(l_shipdate)) AS start FROM lineitem GROUP BY ALL)
 SELECT utt, word, pron, round(post / sum(post) OVER (PARTITION BY utt, word), 6) AS post, CAST(start AS BIGINT) AS start FROM s""")
def arc_posteriors(t):
    a = t.lineitem.select(F.col("l_orderkey").alias("utt"), F.col("l_returnflag").alias("word"), F.col("l_linestatus").alias("pron"), F.col("l_quantity").alias("post"), F.unix_seconds("l_shipdate").alias("start"))
    return C.arc_posteriors(a).withColumn("post", F.round("post", 6))


@query("""WITH c AS (SELECT p_brand AS word, count(*) AS n FROM part GROUP BY 1) SELECT word, n, CASE WHEN n > 8 THEN CAST(sum((n > 8)::INT) OVER (ORDER BY word) AS BIGINT) ELSE 0 END AS category FROM c""")
def word_categories(t):
    return C.categories(t.part.groupBy(F.col("p_brand").alias("word")).agg(F.count("*").alias("n")), "word", 8)


@query("SELECT coalesce(CASE WHEN l_quantity < 5 THEN 'l_quantity too low' WHEN l_quantity > 45 THEN 'l_quantity too high' WHEN l_discount > 0.08 THEN 'l_discount too high' END, 'kept') AS reason, count(*) AS n FROM lineitem GROUP BY 1")
def gate_reasons(t):
    """Why rows fail their bounds."""
    return R.gate_counts(t.lineitem, {"l_quantity": (5, 45), "l_discount": (None, 0.08)})


@query("SELECT event_id FROM events WHERE NOT coalesce(value > 50 AND event_type <> 'x', false)")
def dropped_by_expression(t):
    return R.drop_where(t.events, "value > 50 AND event_type <> 'x'").select("event_id")


@query("SELECT p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) > 8) AND p_type IN (SELECT p_type FROM part WHERE p_size < 25)")
def without_unknown_words(t):
    brands = t.part.groupBy("p_brand").count().filter("count > 8").select("p_brand")
    known = brands.select(F.col("p_brand").alias("w"))
    types = t.part.filter("p_size < 25").select(F.col("p_type").alias("w")).distinct()
    return R.without_unknown(R.without_unknown(t.part, known, "p_brand"), types, "p_type").select("p_partkey")


@query("SELECT doc_id, origin FROM (SELECT doc_id, 'labels' AS origin FROM labels UNION ALL SELECT doc_id, 'documents' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))")
def merged_sources(t):
    """Union in which the earlier source wins."""
    return R.merged(t.labels.select("doc_id", F.lit("labels").alias("origin")).distinct(), t.documents.select("doc_id", F.lit("documents").alias("origin")), by=["doc_id"])


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersected(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query(f"SELECT word FROM (SELECT unnest({SQL_WORDS}) AS word FROM documents) EXCEPT SELECT word FROM (SELECT unnest({SQL_WORDS}) AS word FROM benchmark)")
def vocabulary_difference(t):
    """Words of the documents that the benchmark lacks."""
    w = lambda d: d.select(F.explode(X.words(F.lower("text"))).alias("word")).distinct()
    return w(t.documents).join(w(t.benchmark), "word", "left_anti")


@query("SELECT round(sum(n_chars) / 1000.0 / 60.0 / 60.0, 6) AS hours FROM documents")
def hours_of_arrays(t):
    """Hours summed inside arrays of durations, a thousand documents an array."""
    a = t.documents.groupBy(F.floor(F.col("doc_id") / 1000)).agg(F.collect_list("n_chars").alias("ms"))
    return R.array_hours(a, F.col("ms")).select(F.round("hours", 6).alias("hours"))


@query("SELECT round(sum(strlen(text)) / 2 / 16000 / 3600, 9) AS hours FROM documents")
def hours_of_bytes(t):
    return t.documents.agg(F.round(F.sum(X.pcm_seconds(F.col("text"))) / 3600, 9).alias("hours"))


@query("SELECT event_type AS label, round(sum(value) * 0.5, 4) AS total, row_number() OVER (ORDER BY sum(value) * 0.5 DESC, event_type) AS rank FROM events WHERE value > 0 GROUP BY event_type QUALIFY row_number() OVER (ORDER BY sum(value) * 0.5 DESC, event_type) BETWEEN 2 AND 4")
def class_histogram(t):
    """Scores in maps summed by class; middle ranks."""
    m = t.events.select(F.create_map("event_type", "value").alias("m"))
    return R.class_histogram(m, "m", 0.5, (2, 4)).select("label", F.round("total", 4).alias("total"), F.col("rank").cast("long").alias("rank"))


@query("""SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (SELECT doc_id, regexp_replace(trim(regexp_replace(replace(lower(text), '-', ' '), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), '[^ ''abcdefghijklmnopqrstuvwxyz]', '', 'g') AS t FROM documents)""")
def clean_transcripts(t):
    d = t.documents.select("doc_id", X.clean_transcript(F.col("text")).alias("t"))
    return d.select("doc_id", F.length("t").cast("long").alias("n"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query("SELECT page_id, string_split(url, '/')[-1] AS tail, substr(string_split(url, '/')[-1], 1, CASE WHEN instr(string_split(url, '/')[-1], '-') > 0 THEN instr(string_split(url, '/')[-1], '-') - 1 ELSE 1000 END) AS speaker FROM pages")
def path_parts(t):
    return t.pages.select("page_id", X.tail(F.col("url")).alias("tail"), X.speaker_of(F.col("url")).alias("speaker"))


@query("""SELECT o_orderkey, (o_orderkey % 5 * 3600 + o_custkey % 60 * 60 + o_orderkey % 60) * 1000 + 500 AS clock, CAST(floor((o_custkey % 7 + 0.5) * power(1024, 1 + o_orderkey % 3)) AS BIGINT) AS size,
 CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey AS BIGINT) * 1000 + 250 ELSE -1 END AS ms FROM orders""")
def parsed_quantities(t):
    """Clock times and sizes written as text, some of them no numbers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    unit = F.get(F.array(*map(F.lit, ("K", "mB", "GB"))), (k % 3).cast("int"))
    d = t.orders.select("o_orderkey", F.format_string("%d:%02d:%02d.5", k % 5, c % 60, k % 60).alias("clock"), F.concat((c % 7).cast("string"), F.lit(".5"), unit).alias("size"), F.when(k % 4 > 0, F.concat(k.cast("string"), F.lit(".25"))).otherwise(F.lit("n/a")).alias("ms"))
    return d.select("o_orderkey", X.clock_ms(F.col("clock")).alias("clock"), X.byte_size(F.col("size")).alias("size"), F.coalesce(X.clock_ms(F.col("ms")), F.lit(-1).cast("long")).alias("ms"))


@query("SELECT item_id, len(list_distinct(list_transform(range(1, greatest(length(text) - 1, 1)), lambda i: substr(text, i, 3)))) AS trigrams FROM benchmark")
def character_trigrams(t):
    return t.benchmark.select("item_id", F.size(F.array_distinct(X.ngrams(F.col("text"), 3))).cast("long").alias("trigrams"))


@query("SELECT lang, list(DISTINCT source ORDER BY source)[1] AS first_source, count(DISTINCT source) AS n FROM documents GROUP BY lang")
def distinct_sources(t):
    return t.documents.groupBy("lang").agg(F.min("source").alias("first_source"), F.count_distinct("source").alias("n"))


@query("SELECT count(*) FILTER (l.doc_id IS NULL) AS unlabelled, coalesce(sum(n_chars) FILTER (l.doc_id IS NULL), 0)::BIGINT AS missing_chars FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def missing_labels(t):
    """Counts and totals of rows without a partner."""
    j = t.documents.join(t.labels.select("doc_id", F.lit(True).alias("has")).distinct(), "doc_id", "left")
    return j.agg(F.count_if(F.col("has").isNull()).alias("unlabelled"), F.coalesce(F.sum(F.when(F.col("has").isNull(), F.col("n_chars"))), F.lit(0)).alias("missing_chars"))


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_id % 6 AS k FROM events),
 s AS (SELECT *, k IN (0, 1) AS soft, k IN (2, 3) AS err FROM e), r AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id, soft ORDER BY pos) AS g FROM s),
 edge AS (SELECT user_id, g, min(pos) AS a, max(pos) AS b FROM r WHERE soft GROUP BY ALL)
 SELECT event_id, soft AND (coalesce((SELECT err FROM s x WHERE x.user_id = r.user_id AND x.pos = edge.a - 1), false) OR coalesce((SELECT err FROM s x WHERE x.user_id = r.user_id AND x.pos = edge.b + 1), false)) AS tainted
 FROM r LEFT JOIN edge ON soft AND edge.user_id = r.user_id AND edge.g = r.g""")
def tainted_edits(t):
    """Soft edits next to errors."""
    kinds = F.get(F.array(*map(F.lit, ("sil", "fix", "ins", "sub", "cor", "cor"))), (F.col("event_id") % 6).cast("int"))
    e = t.events.select("user_id", "event_id", F.struct("ts", "event_id").alias("pos"), kinds.alias("edit_type"), F.lit(False).alias("oov"))
    return S.tainted(e, "user_id", "pos").select("event_id", "tainted")


@query()
def combined_utterances(t):
    """Short utterances merged within a speaker (greedy: no SQL)."""
    return S.combine_utterances(t.lineitem.select(F.col("l_suppkey").cast("string").alias("speaker"), F.format_string("%08d-%02d", "l_orderkey", "l_linenumber").alias("utt"), F.col("l_quantity").alias("dur")), 10.0)


@query("SELECT s_suppkey, l_orderkey, l_linenumber, s_suppkey || '-' || lpad(CAST(CAST(floor((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1) / 10) AS INT) AS VARCHAR), 3, '0') AS part FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def speaker_parts(t):
    d = t.lineitem.select(F.col("l_suppkey").cast("string").alias("speaker"), "l_suppkey", "l_orderkey", "l_linenumber", F.struct("l_orderkey", "l_linenumber").alias("k"))
    return S.split_speakers(d, "speaker", "k", 10).select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber", "part")


def shared_passages(t):
    """(doc_id, transcript, item_id, fragments): documents with benchmark passages that share eight words in a row with them."""
    grams = F.expr("CASE WHEN size(words) >= 8 THEN transform(sequence(1, size(words) - 7), i -> xxhash64(slice(words, i, 8))) END")
    worded = lambda df, key: df.select(key, X.words(F.lower("text")).alias("words"))
    gram = lambda df, key: df.select(key, F.explode(F.array_distinct(grams)).alias("gram"))
    asked = gram(worded(t.benchmark, "item_id"), "item_id")
    asked = F.broadcast(asked) if asked.count() <= 500_000 else asked
    shared = gram(worded(t.documents, "doc_id"), "doc_id").join(asked, "gram").select("item_id", "doc_id").distinct()
    parts = F.transform(S.split_documents(F.col("words"), 12), lambda w, i: F.struct((i * 1000).cast("long").alias("start"), ((i + 1) * 1000).cast("long").alias("end"), F.array_join(w, " ").alias("transcript")))
    passages = worded(t.benchmark, "item_id").select("item_id", parts.alias("fragments"))
    d = t.documents.select("doc_id", F.col("text").alias("transcript")).join(shared, "doc_id").join(passages, "item_id")
    return d


def aligned_passages(t, settings=None):
    from corpusflow.operators.alignment import Settings, align_table, all_in_time

    made = all_in_time(align_table(shared_passages(t).repartition(tasks(t.spark)), settings=settings or Settings()))
    return made.select("item_id", "doc_id", F.size("fragments").alias("n"), F.size("alignments.label").alias("aligned"), F.round(F.array_max("alignments.cer").cast("double"), 4).alias("worst_cer"))


@query()
def aligned_documents(t):
    """Benchmark passages found again in whole documents that share eight words in a row with them: fragments of a passage,
    12 words at most, aligned to the document's text (dynamic programming: no SQL)."""
    return aligned_passages(t)


@query()
def snapped_documents(t):
    """The same with the ends of matches moved to where they fit best."""
    from corpusflow.operators.alignment import Settings

    return aligned_passages(t, Settings(snap=True))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def top_slice(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(20)


@query("SELECT ntile(8) OVER (ORDER BY c_custkey) AS part, c_custkey FROM customer")
def even_split(t):
    return R.evenly(t.customer.select("c_custkey"), ["c_custkey"], 8).select(F.col("part").cast("long").alias("part"), "c_custkey")


@query("""WITH c AS (SELECT o_orderkey, o_totalprice, unnest([0.9, 1.0, 1.1]) AS speed FROM orders), n AS (SELECT *, CASE WHEN speed = 1.0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'sp' || speed || '-' || o_orderkey END AS name FROM c)
 SELECT name, round(o_totalprice / speed, 4) AS duration, round(0.5 + CAST(('0x' || substr(md5('perturb/' || name), 1, 8)) AS BIGINT) / 4294967295.0 * 1.5, 6) AS volume FROM n""")
def perturbed_copies(t):
    """Copies at three speeds with a fixed random volume."""
    from corpusflow.operators.edits import perturbed

    return perturbed(t.orders.select("o_orderkey", F.col("o_totalprice").alias("duration")), "o_orderkey", "duration", volumes=(0.5, 2.0)).select("name", F.round("duration", 4).alias("duration"), F.round("volume", 6).alias("volume"))


@query("""WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS s, epoch_us(ts) / 1000000.0 + value * 2000 AS e, (event_id % 7) / 10.0 AS rate FROM events),
 n AS (SELECT *, lag(e) OVER w AS pe, lag(rate) OVER w AS pr, lead(s) OVER w AS ns, lead(rate) OVER w AS nr FROM s WINDOW w AS (PARTITION BY user_id ORDER BY s, e, event_id)),
 x AS (SELECT event_id, CASE WHEN pe > s AND pr <= rate THEN pe ELSE s END AS a, CASE WHEN ns < e AND nr < rate THEN ns ELSE e END AS b FROM n)
 SELECT event_id, round(a, 3) AS "from", round(greatest(a, b), 3) AS "to" FROM x""")
def overlap_owners(t):
    """Overlaps given to the neighbour with the lower error rate."""
    from corpusflow.operators.edits import better_halves

    s = t.events.select("user_id", F.col("event_id").alias("utt"), seconds_of(F.col("ts")).alias("start"), (seconds_of(F.col("ts")) + F.col("value") * 2000).alias("end"), (F.col("event_id") % 7).alias("errors"), F.lit(10).alias("words"))
    return better_halves(s, "user_id").select(F.col("utt").alias("event_id"), F.round("from", 3).alias("from"), F.round("to", 3).alias("to"))


@query("SELECT doc_id, concat_ws(' ', coalesce(CAST(quality AS VARCHAR), '*'), coalesce(lang, '*'), source) AS credits FROM documents LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) l USING (doc_id)")
def starred_credits(t):
    """Columns joined, nulls as stars."""
    j = t.documents.join(t.labels.select("doc_id", "quality").distinct(), "doc_id", "left")
    return j.select("doc_id", X.starred(F.col("quality"), F.col("lang"), F.col("source")).alias("credits"))


@query("SELECT p_size AS rate, round(sum(p_retailprice) / 3600.0, 6) AS hours, count(*) AS n FROM part GROUP BY p_size")
def hours_per_rate(t):
    """Hours and files of each sampling rate in one pass."""
    return R.hours_by(t.part, F.col("p_size"), F.col("p_retailprice"), "rate").select("rate", F.round("hours", 6).alias("hours"), "n")


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS utterances FROM orders GROUP BY o_custkey")
def utterances_of_speakers(t):
    """Each speaker's utterances on one line, in order (a customer stands for a speaker)."""
    return R.collected(t.orders.withColumn("id", F.col("o_orderkey").cast("string")), "o_custkey", "id", ["o_orderkey"], name="utterances")


@query(f"WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS word FROM documents) GROUP BY word) SELECT word, round(sum(n) OVER (ORDER BY n DESC, word) / sum(n) OVER (), 9) AS covered FROM c QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 100")
def vocabulary_coverage(t):
    return C.vocabulary(t.documents, "text", 100).select("word", F.round("covered", 9).alias("covered"))


@query("""WITH k AS (SELECT c_custkey, row_number() OVER (ORDER BY md5('42/' || c_custkey), c_custkey) AS rn FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')),
 h AS (SELECT c_custkey, CASE WHEN rn <= 10 THEN 'test' ELSE 'dev' END AS split FROM k WHERE rn <= 30)
 SELECT * FROM h UNION ALL SELECT c_custkey, 'train' FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' AND c_custkey NOT IN (SELECT c_custkey FROM h)""")
def released_split(t):
    """Test and development from two segments; the rest of the first and all others for training, nothing twice."""
    c = lambda which: t.customer.filter(which).select("c_custkey")
    return P.released_split(c("c_mktsegment = 'BUILDING'"), c("c_mktsegment = 'AUTOMOBILE'"), c("c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE')"), "c_custkey", 10, 20)


@query("SELECT l_orderkey || '_' || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag) - 1 AS VARCHAR), 5, '0') || '.flac' AS audio_filepath, l_returnflag AS text, l_quantity / 1000.0 AS duration FROM lineitem")
def trainer_manifests(t):
    """Nested manifests as a row a chunk."""
    from corpusflow.operators.alignment import trainer_manifest

    soa = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag"))).alias("r"))
    data = F.struct(F.transform("r", lambda x: x["l_quantity"]).alias("duration_ms"), F.transform("r", lambda x: x["l_returnflag"]).alias("label"), X.chunk_names(F.col("l_orderkey").cast("string"), F.size("r"), "flac").alias("name"))
    return trainer_manifest(soa.select(data.alias("training_data"))).select("audio_filepath", "text", "duration")


@query("SELECT url, arg_min(page_id, page_id) AS page_id FROM pages GROUP BY url")
def first_hits(t):
    """One hit for each address, the first."""
    return R.first_of(t.pages.select("url", "page_id"), ["url"], ["page_id"])


@query("SELECT count(*) FILTER (text IS NULL) AS texts, count(*) FILTER (lang IS NULL) AS langs FROM documents")
def null_counts(t):
    return t.documents.agg(F.count_if(F.col("text").isNull()).alias("texts"), F.count_if(F.col("lang").isNull()).alias("langs"))


@query("SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 100000")
def looked_up_names(t):
    """Lookups in small tables: the planner broadcasts what is small enough."""
    return t.orders.filter("o_totalprice > 100000").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "n_name")


@query()
def subword_texts(t):
    """Benchmark texts in subwords learned from the documents (iterative merging: no SQL)."""
    from corpusflow.operators import lm

    merges = lm.learn_bpe(t.documents, "text", 200)
    return t.benchmark.select("item_id", lm.apply_bpe(t.benchmark, "text", merges).alias("text"))


@query()
def utterance_edits(t):
    """Edits of the words of two neighbouring turns (dynamic programming: no SQL)."""
    from corpusflow.operators import edits

    w = W.partitionBy("conv_id").orderBy("turn")
    p = t.conversations.withColumn("ref", F.lag("text").over(w)).filter("ref IS NOT NULL")
    p = p.select("conv_id", "turn", "ref", "text").repartition(tasks(t.spark))
    ops = p.select("conv_id", "turn", edits.aligned_words(p, "ref", "text").alias("ops"))
    return ops.select("conv_id", "turn", edits.edit_counts(F.col("ops")).alias("n")).select("conv_id", "turn", "n.*")


@query("""WITH s AS (SELECT user_id AS query, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place, value AS score FROM events),
 b AS (SELECT query, place AS best, score AS top FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, place) = 1),
 n AS (SELECT query, place, score >= 0.9 * top AS whole FROM s JOIN b USING (query) WHERE abs(place - best) <= 2),
 e AS (SELECT *, coalesce(lag(whole) OVER w, false) AS before, coalesce(lead(whole) OVER w, false) AS after FROM n WINDOW w AS (PARTITION BY query ORDER BY place))
 SELECT query, place, CAST(CASE WHEN whole THEN 1 WHEN before THEN 0.2 ELSE 0 END AS DOUBLE) AS from_start, CAST(CASE WHEN whole THEN 1 WHEN after THEN 0.2 ELSE 0 END AS DOUBLE) AS from_end FROM e WHERE whole OR before OR after""")
def retrieved_documents(t):
    """The best document of each query with its neighbours, whole or in part."""
    place = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return C.retrieved(t.events.select(F.col("user_id").alias("query"), place.alias("place"), F.col("value").alias("score")), 2)


@query("""WITH w AS (SELECT l_orderkey AS utt, l_returnflag AS word, round(l_quantity, 2) AS s, round(l_quantity + l_linenumber, 2) AS e, l_linestatus AS pron FROM lineitem),
 j AS (SELECT a.word, b.pron, 1.0 / count(*) OVER (PARTITION BY a.utt, a.word, a.s, a.e) AS share FROM w a JOIN w b ON a.utt = b.utt AND a.s = b.s AND a.e = b.e)
 SELECT word, pron, CAST(round(sum(share), 4) AS DOUBLE) AS n FROM j GROUP BY ALL""")
def pronunciation_counts(t):
    d = t.lineitem.select(F.col("l_orderkey").alias("utt"), F.col("l_returnflag").alias("word"), F.col("l_linestatus").alias("pron"), F.col("l_quantity").alias("start"), F.col("l_linenumber").cast("double").alias("dur"))
    return C.pronunciation_counts(d, d).withColumn("n", F.round("n", 4))


def _sql_stop_words() -> str:
    counts = ", ".join(f"{{'n': -len(list_intersect(w, {words!r})), 'code': '{code}'}}" for code, words in sorted(X.STOP_WORDS.items()))
    return f"WITH w AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents), b AS (SELECT doc_id, list_min([{counts}]) AS b FROM w) SELECT doc_id, CASE WHEN b.n <= -1 THEN b.code ELSE '' END AS lang FROM b"


@query(_sql_stop_words())
def guessed_languages(t):
    """Language by frequent words, without a model."""
    w = t.documents.select("doc_id", X.words(F.lower("text")).alias("w"))
    return w.select("doc_id", X.guessed_language(F.col("w")).alias("lang"))


@query("""WITH w AS (SELECT item_id, regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+') AS w FROM benchmark), f AS (SELECT item_id, len(w) AS n, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM w)
 SELECT item_id, string_agg(x, ' ' ORDER BY -length(x), i) AS by_length, string_agg(x, ' ' ORDER BY abs(i - n // 2), -i) AS outwards FROM f GROUP BY item_id""")
def ordered_words(t):
    """Words by length, and from the middle outwards."""
    w = t.benchmark.select("item_id", F.split("text", r"\s+").alias("w"))
    return w.select("item_id", F.array_join(X.longest_first(F.col("w")), " ").alias("by_length"), F.array_join(X.outwards(F.col("w")), " ").alias("outwards"))

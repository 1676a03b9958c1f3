"""Queries over timed edits: merging, local alignment, segment construction, and lexicons."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import augment as A
from corpusflow.operators import lexicons as L
from corpusflow.operators import segments as G
from corpusflow.operators import sequences as S
from corpusflow.plans.catalog import query
from corpusflow.session import tasks

RULES = G.SegmentRules(unscored=("error",))
KINDS = ("sil", "del", "sub", "ins", "fix", "sil") + ("cor",) * 44


def edit_lines(t):
    """Events as edit lines of their users: of fifty, two are silence, one each deleted, substituted, inserted and fixed."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    kind = F.get(F.array(*map(F.lit, KINDS)), (F.col("event_id") * 7 % 50).cast("int"))
    e = t.events.select("user_id", F.row_number().over(w).alias("pos"), kind.alias("edit_type"), "event_type", "event_id", (F.col("event_id") % 40 / 20).alias("long"))
    dur = F.when(F.col("edit_type") == "del", 0.0).when(F.col("edit_type") == "sil", F.col("long") * 2).when(F.col("event_type") == "error", F.col("long") * 1.5).otherwise(F.round(0.1 + F.col("long") / 8, 3))
    silent = lambda *kinds: F.when(F.col("edit_type").isin(*kinds), G.EPS).otherwise(F.col("event_type"))
    e = e.withColumn("dur", dur).withColumn("start", F.round(F.coalesce(F.sum("dur").over(W.partitionBy("user_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)), 6))
    e = e.withColumn("hyp", F.when(F.col("edit_type") == "sub", "other").otherwise(silent("sil", "del"))).withColumn("ref", silent("sil", "ins"))
    return S.tainted(e.withColumn("oov", F.lit(False)), "user_id", "pos").drop("oov", "long", "event_id", "event_type")


@query()
def constructed_segments(t):
    """Segments made of edit lines in twelve stages (a state machine: held against plain Python)."""
    return G.segments_of(edit_lines(t), RULES, "user_id").drop("n")


@query()
def excluded_words(t):
    """Words by how often they lie in no segment (stands on the stages above)."""
    lines = G.numbered_lines(edit_lines(t), RULES, "user_id")
    d = G.segment_rows(lines, RULES, "user_id")
    return G.words_outside(lines, d, "user_id").select("word", "n", "outside", F.round("badness", 6).alias("badness"))


_SQL_WORDS = """e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_id, event_type FROM events),
 t AS (SELECT user_id, pos, pos * 0.5 AS start, 0.4 AS dur, CASE WHEN event_id % 9 = 0 THEN '<eps>' ELSE event_type END AS word FROM e),
 p AS (SELECT user_id, pos * 2 AS pos, event_type AS hyp, CASE WHEN event_id % 5 = 0 THEN '<eps>' WHEN event_id % 7 = 0 THEN 'other' ELSE event_type END AS ref FROM e WHERE event_id % 9 <> 0
  UNION ALL SELECT user_id, pos * 2 + 1, '<eps>', 'gone' FROM e WHERE event_id % 4 = 0)"""


@query(f"""WITH {_SQL_WORDS}, tk AS (SELECT *, count(*) FILTER (word <> '<eps>') OVER (PARTITION BY user_id ORDER BY pos) AS k FROM t),
 pk AS (SELECT *, count(*) FILTER (hyp <> '<eps>') OVER (PARTITION BY user_id ORDER BY pos) AS k FROM p),
 m AS (SELECT a.user_id, a.k, 0 AS class, 0 AS o, a.start, a.dur, hyp, ref FROM tk a JOIN pk b ON a.user_id = b.user_id AND a.k = b.k AND word <> '<eps>' AND hyp <> '<eps>'
  UNION ALL SELECT b.user_id, b.k, 1, b.pos, coalesce(a.start + a.dur, f.start), 0, '<eps>', ref FROM pk b LEFT JOIN tk a ON a.user_id = b.user_id AND a.k = b.k AND word <> '<eps>'
   LEFT JOIN (SELECT user_id, min(start) AS start FROM t GROUP BY 1) f ON f.user_id = b.user_id WHERE hyp = '<eps>'
  UNION ALL SELECT user_id, k, 2, pos, start, dur, '<eps>', '<eps>' FROM tk WHERE word = '<eps>')
 SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY k, class, o) - 1 AS INTEGER) AS pos, round(start, 6)::DOUBLE AS start, dur::DOUBLE AS dur, hyp, ref,
  CASE WHEN hyp = ref AND hyp <> '<eps>' THEN 'cor' WHEN hyp <> '<eps>' AND ref = '<eps>' THEN 'ins' WHEN hyp = '<eps>' AND ref <> '<eps>' THEN 'del' WHEN hyp = '<eps>' THEN 'sil' ELSE 'sub' END AS edit_type FROM m""")
def merged_edit_lines(t):
    """Timed words and aligned words without times, merged to edit lines."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = t.events.select("user_id", F.row_number().over(w).alias("pos"), "event_id", "event_type")
    words = e.select("user_id", "pos", (F.col("pos") * 0.5).alias("start"), F.lit(0.4).alias("dur"), F.when(F.col("event_id") % 9 == 0, G.EPS).otherwise(F.col("event_type")).alias("word"))
    ref = F.when(F.col("event_id") % 5 == 0, G.EPS).when(F.col("event_id") % 7 == 0, "other").otherwise(F.col("event_type"))
    pairs = e.filter("event_id % 9 <> 0").select("user_id", (F.col("pos") * 2).alias("pos"), F.col("event_type").alias("hyp"), ref.alias("ref"))
    pairs = pairs.unionByName(e.filter("event_id % 4 = 0").select("user_id", (F.col("pos") * 2 + 1).alias("pos"), F.lit(G.EPS).alias("hyp"), F.lit("gone").alias("ref")))
    return G.merged_edits(words, pairs, "user_id").withColumn("start", F.round("start", 6))


@query()
def locally_aligned_turns(t):
    """Turns as timed words, with a silence after every fifth, aligned to the words of the turn before them (dynamic programming: no SQL)."""
    before = F.lag("text").over(W.partitionBy("conv_id").orderBy("turn"))
    d = t.conversations.withColumn("ref", X.words(F.lower(before))).withColumn("said", X.words(F.lower("text"))).filter("ref IS NOT NULL")
    word = lambda w, i: F.struct((i * 0.5).alias("start"), F.lit(0.4).alias("dur"), w.alias("word"))
    quiet = lambda i: F.when(i % 5 == 4, F.array(F.struct((i * 0.5 + 0.4).alias("start"), F.lit(0.1).alias("dur"), F.lit(G.EPS).alias("word"))))
    d = d.withColumn("words", F.flatten(F.transform("said", lambda w, i: F.concat(F.array(word(w, i)), F.coalesce(quiet(i), F.array().cast("array<struct<start:double,dur:double,word:string>>"))))))
    d = d.repartition(tasks(t.spark))
    return d.select("conv_id", "turn", F.posexplode(G.locally_aligned(d, "ref", "words")).alias("pos", "line")).select("conv_id", "turn", "pos", F.round("line.start", 3).alias("start"), "line.dur", "line.hyp", "line.ref", "line.edit_type")


def pronunciations(t):
    """(candidates, arcs, soft counts): items' kinds as words, brands as phones; sale lines are places where a word was heard."""
    items = t.items.filter("kind IS NOT NULL AND brand IS NOT NULL").select("item_id", F.col("kind").alias("word"), F.col("brand").alias("pron"), "size")
    lexicon = lambda k: items.filter(F.col("size") % 5 == k).select("word", "pron").distinct()
    c = L.candidates(lexicon(0), lexicon(1), lexicon(2).unionByName(items.select("word", F.lit("SIL").alias("pron")).distinct()), items, ["SIL"])
    heard = t.sale_lines.filter("sale_id IS NOT NULL AND item_id IS NOT NULL AND line_no IS NOT NULL").join(items.select("item_id", "word", "pron"), "item_id")
    arcs = heard.groupBy("word", F.col("sale_id").alias("utt"), F.col("line_no").alias("start"), "pron").agg(F.least(F.lit(1.0), F.count("*") / 4).alias("n"))
    return c, arcs, arcs.groupBy("word", "pron").agg(F.sum("n").alias("n"))


_SQL_PRONS = """i AS (SELECT item_id, kind AS word, brand AS pron, size FROM items WHERE kind IS NOT NULL AND brand IS NOT NULL),
 c AS (SELECT DISTINCT word, pron, ['R', 'G', 'P'][size % 5 + 1] AS source FROM i WHERE size % 5 < 3),
 a AS (SELECT word, sale_id, line_no, pron, least(1.0, count(*) / 4) AS n FROM sale_lines JOIN i USING (item_id) WHERE sale_id IS NOT NULL AND line_no IS NOT NULL GROUP BY ALL),
 n AS (SELECT word, pron, sum(n) AS n FROM a GROUP BY ALL),
 s AS (SELECT word, source, count(*) AS held, CASE source WHEN 'R' THEN 0.6 WHEN 'G' THEN 0.3 ELSE 0.1 END AS mean FROM c GROUP BY ALL),
 r AS (SELECT word, source, 15.0 * mean / sum(mean) OVER (PARTITION BY word) / held AS prior FROM s),
 m AS (SELECT c.word, c.pron, source, prior + coalesce(n, 0) AS mass FROM c JOIN r USING (word, source) LEFT JOIN n ON n.word = c.word AND n.pron = c.pron),
 p AS (SELECT word, pron, source, mass / sum(mass) OVER (PARTITION BY word) AS posterior FROM m)"""


@query(f"WITH {_SQL_PRONS} SELECT word, pron, source, round(posterior, 6) AS posterior FROM p")
def pron_posteriors(t):
    """Posteriors of pronunciations from soft counts and priors by source."""
    c, _, counts = pronunciations(t)
    return L.pron_posteriors(c, counts, {"R": 0.6, "G": 0.3, "P": 0.1}).withColumn("posterior", F.round("posterior", 6))


@query()
def learned_prons(t):
    """Pronunciations by posterior: number, mass, equals and what the reference adds (held against plain Python)."""
    c, _, counts = pronunciations(t)
    return L.select_by_posterior(L.pron_posteriors(c, counts, {"R": 0.6, "G": 0.3, "P": 0.1}))


@query()
def greedy_prons(t):
    """Pronunciations that are left when those whose loss costs least likelihood go (expectation and maximisation: no SQL)."""
    c, arcs, _ = pronunciations(t)
    return L.select_greedily(c, arcs, {"R": 0.01, "G": 0.05, "P": 0.1}, {"R": 0, "G": 10, "P": 10})


@query()
def edited_lexicon(t):
    """The reference lexicon after the edits that learning by posterior proposes."""
    c, _, counts = pronunciations(t)
    learned = L.select_by_posterior(L.pron_posteriors(c, counts, {"R": 0.6, "G": 0.3, "P": 0.1}))
    return L.edited_lexicon(c.filter("source = 'R'"), L.lexicon_edits(c, learned, counts))


@query()
def combined_across_speakers(t):
    """Turns merged within a conversation, and what is too short as a whole with its neighbours (greedy: no SQL)."""
    d = t.conversations.select(F.format_string("c%08d", "conv_id").alias("speaker"), F.format_string("c%08d-%04d", "conv_id", "turn").alias("utt"), (F.greatest(F.length("text"), F.lit(1)) / 100).alias("dur"))
    return S.combine_across_speakers(d, 8.0).select("name", "speaker", F.size("members").alias("members"), F.round("dur", 4).alias("dur"))


@query()
def segmented_recordings(t):
    """Conversations as long recordings, their turns (every ninth missing, others put before and after) as transcripts: segments with their text."""
    from corpusflow.operators import relational as R
    from corpusflow.plans import longform
    from corpusflow.session import folder

    turn = t.conversations.select("conv_id", "turn", X.words(F.lower("text")).alias("w"))
    w = W.partitionBy("conv_id").orderBy("turn", "i")
    flat = turn.select("conv_id", "turn", F.posexplode("w").alias("i", "word"))
    words = flat.select(F.col("conv_id").alias("recording"), ((F.row_number().over(w) - 1) * 0.4).alias("start"), F.lit(0.35).alias("dur"), "word")
    told = turn.filter("turn % 9 <> 8").select("conv_id", F.col("turn").cast("int").alias("turn"), F.array_join("w", " ").alias("text"))
    told = told.unionByName(t.conversations.select("conv_id").distinct().select("conv_id", F.explode(F.array(F.lit(-1), F.lit(1 << 30))).alias("turn"), F.lit("music and other words that nobody says here").alias("text")))
    transcripts = R.collected(told, "conv_id", "text", ["turn"], name="text").withColumnRenamed("conv_id", "recording")
    made = longform.segmented(t.spark, words, transcripts, folder(t.spark), longform.LongForm(document_words=200))
    return made.select("recording", "segment", "start", "end", "text")


@query()
def kn_sentence_scores(t):
    """Benchmark passages under a Kneser-Ney model of order 3 of all documents, written as ARPA lines and read again (held against plain Python)."""
    from corpusflow.operators import lm, trigrams
    from corpusflow.session import folder
    from corpusflow.sources import text_formats as T

    path = folder(t.spark)
    t.spark.createDataFrame([("\\1-grams:",), ("-7.0\t<unk>",)], "value string").write.option("compression", "gzip").text(path)
    trigrams.write_arpa(t.documents, "text", path)
    asked = t.benchmark.select("item_id", F.lower("text").alias("text"))
    return lm.joined_scores(asked, "item_id", "text", T.arpa(t.spark, path), 3).select("item_id", F.round("logp", 3).alias("logp"))


_SQL_ROOMS = """r AS (SELECT p_partkey AS rir, p_brand AS room, CASE WHEN p_size % 3 > 0 THEN p_size / 1000000.0 END AS probability FROM part),
 t AS (SELECT count(*) FILTER (probability IS NULL) AS none, sum(probability) AS given FROM r),
 e AS (SELECT rir, room, coalesce(0.7 * probability + 0.3 * even, even) AS p FROM r, (SELECT CASE WHEN none > 0 AND given < 1 THEN (1 - given) / none ELSE 0 END AS even FROM t)),
 n AS (SELECT rir, room, p / sum(p) OVER () AS p FROM e)"""


def rooms(t):
    """Parts as impulse responses, brands as their rooms; two of three have a probability."""
    given = F.when(F.col("p_size") % 3 > 0, F.col("p_size") / 1000000.0)
    return A.smoothed(t.part.select(F.col("p_partkey").alias("rir"), F.col("p_brand").alias("room"), given.alias("probability")), 0.3)


@query(f"WITH {_SQL_ROOMS} SELECT room, count(*) AS rirs, round(sum(p), 9) AS probability FROM n GROUP BY room")
def smoothed_rooms(t):
    """Smoothed probabilities of rooms: of their impulse responses together."""
    return rooms(t).groupBy("room").agg(F.count("*").alias("rirs"), F.round(F.sum("probability"), 9).alias("probability"))


@query(f"""WITH {_SQL_ROOMS}, c AS (SELECT 'rvb' || k || '-' || o_orderkey AS name FROM orders, (VALUES (1), (2)) v(k)),
 line AS (SELECT rir, room, coalesce(sum(p) OVER (ORDER BY rir ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, CASE WHEN lead(rir) OVER (ORDER BY rir) IS NULL THEN 2 ELSE sum(p) OVER (ORDER BY rir ROWS UNBOUNDED PRECEDING) END AS b FROM n WHERE p > 0),
 u AS (SELECT name, CAST(('0x' || substr(md5('rir/' || name), 1, 8)) AS BIGINT) / 4294967296.0 AS u, CAST(('0x' || substr(md5('wet/' || name), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8 AS wet FROM c)
 SELECT name, rir, room, wet FROM u ASOF JOIN line ON u.u >= line.a""")
def reverberated_copies(t):
    """Two copies of each recording with an impulse response, the same at every run."""
    named = A.copies(t.orders.select(F.col("o_orderkey").alias("utt")), 2)
    return A.reverberated(named, rooms(t), 0.8).select("name", "rir", "room", "wet")


@query()
def added_noises(t):
    """Point noises of the copies: which, through which impulse response, when and how loud (stands on numbering: held against plain Python)."""
    wet = A.reverberated(A.copies(t.orders.select(F.col("o_orderkey").alias("utt"), (F.col("o_totalprice") / 2000).alias("dur")), 1), rooms(t), 0.8)
    noises = A.smoothed(t.supplier.select(F.col("s_suppkey").alias("noise"), F.when(F.col("s_suppkey") % 4 == 0, "background").otherwise("foreground").alias("kind"), F.lit(None).cast("double").alias("probability")))
    return A.noises_added(wet, noises, rooms(t), (20.0, 10.0, 15.0, 5.0, 0.0), (20.0, 10.0), 0.9, 2.0)

"""Queries over names, texts, lists, labels and word times: what the other modules' queries leave out."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import text as X
from corpusflow.operators import corpus as C
from corpusflow.operators import edits as E
from corpusflow.operators import relational as R
from corpusflow.operators import sequences as S
from corpusflow.plans.catalog import SQL_WORDS, query, seconds_of
from corpusflow.session import tasks

# Filters and joins


@query("SELECT doc_id FROM documents JOIN (SELECT doc_id, count(quality) AS n FROM labels GROUP BY 1) USING (doc_id) WHERE n = 1")
def single_entities(t):
    """Rows whose entity is known and one; rows with none or several go."""
    sets = t.labels.groupBy("doc_id").agg(F.count("quality").alias("n"))
    return t.documents.select("doc_id").join(sets.filter("n = 1"), "doc_id").select("doc_id")


@query("SELECT event_id, value FROM events WHERE value <= 15")
def short_recordings(t):
    """Recordings of at most fifteen seconds."""
    return t.events.select("event_id", "value").withColumn("reason", R.gate_reason({"value": (None, 15)})).filter("reason IS NULL").drop("reason")


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'seen' ELSE event_type END AS label FROM events WHERE event_type NOT IN ('error')")
def relabelled_events(t):
    """Rows of unwanted kinds left out, labels put together."""
    kind = F.col("event_type")
    return t.events.filter(~kind.isin("error")).select("event_id", F.when(kind.isin("click", "view"), "seen").otherwise(kind).alias("label"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' OR doc_id % 5 = 0 OR source = 'web'")
def permitted_documents(t):
    """Documents that a user may see: granted to that user or to all, or the user's own."""
    docs = t.documents.select("doc_id", F.when(F.col("source") == "web", "ann").otherwise("bob").alias("owner"))
    grants = t.documents.filter("lang = 'en'").select("doc_id", F.lit("ann").alias("who")).unionByName(t.documents.filter("doc_id % 5 = 0").select("doc_id", F.lit("*").alias("who"))).unionByName(t.documents.select("doc_id", F.lit("carl").alias("who")))
    return R.permitted(docs, grants, "doc_id", "ann", "owner").select("doc_id")


@query("SELECT l_orderkey, o_orderpriority, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def merge_joined(t):
    """Two large sides joined by sorting, with the broadcast switched off by a hint."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority").hint("merge")
    return t.lineitem.select("l_orderkey").join(o, "l_orderkey").groupBy("l_orderkey", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS named, count(*) FILTER (doc_id % 7 <> 0) AS held, count(*) FILTER (doc_id % 7 = 0) AS missing FROM documents")
def verified_manifest(t):
    """A manifest's names against an archive's keys: what is there and what is not."""
    named = t.documents.select(F.concat(F.col("doc_id").cast("string"), F.lit(".flac")).alias("name"))
    keys = t.documents.filter("doc_id % 7 <> 0").select(F.concat(F.col("doc_id").cast("string"), F.lit(".flac")).alias("name"), F.lit(True).alias("held"))
    return named.join(keys, "name", "left").agg(F.count("*").alias("named"), F.count_if("held").alias("held"), F.count_if(F.col("held").isNull()).alias("missing"))


@query("SELECT doc_id, lang, quality FROM documents JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)")
def scored_predictions(t):
    """Predictions with their references; those without one are skipped."""
    return t.documents.select("doc_id", "lang").join(t.labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id")


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id FROM documents")
def document_numbers(t):
    """Numbers from 0 without a gap, the same at every run."""
    return R.numbered(t.documents.select("doc_id"), ["doc_id"], "id")


@query("SELECT 'd' || doc_id AS name, CAST(doc_id % 2 AS INT) AS part FROM documents UNION ALL SELECT 'l' || doc_id, 2 FROM labels")
def combined_folders(t):
    """Data of several folders put together, whatever their order of columns."""
    a = t.documents.select(F.concat(F.lit("d"), "doc_id").alias("name"), (F.col("doc_id") % 2).cast("int").alias("part"))
    return a.unionByName(t.labels.select(F.lit(2).alias("part"), F.concat(F.lit("l"), "doc_id").alias("name")))


# Aggregations


@query("SELECT l_suppkey, string_agg(l_orderkey || '-' || l_linenumber, ' ' ORDER BY CAST(l_quantity AS VARCHAR), CAST(l_quantity + l_linenumber AS VARCHAR), l_orderkey, l_linenumber) AS utterances FROM lineitem GROUP BY l_suppkey")
def recording_utterances(t):
    """Utterances of each recording in the order of start and end, compared as texts."""
    d = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("s"), (F.col("l_quantity") + F.col("l_linenumber")).cast("string").alias("e"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("utt"))
    return R.collected(d, "l_suppkey", "utt", ["s", "e", "l_orderkey", "l_linenumber"], name="utterances")


@query("SELECT value, count(*) AS n FROM (SELECT unnest([lang, source, CASE WHEN doc_id % 3 = 0 THEN lang END]) AS value FROM documents) WHERE value IS NOT NULL GROUP BY value")
def value_counts_of_lists(t):
    """Values of fields that hold one or a list, counted."""
    return t.documents.select(F.explode(F.array("lang", "source", F.when(F.col("doc_id") % 3 == 0, F.col("lang")))).alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))


_SQL_EDITS = """e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_id % 6 AS k FROM events),
 s AS (SELECT *, k IN (0, 1) AS soft, k IN (2, 3) AS err FROM e), r AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id, soft ORDER BY pos) AS g FROM s),
 edge AS (SELECT user_id, g, min(pos) AS a, max(pos) AS b FROM r WHERE soft GROUP BY ALL),
 m AS (SELECT r.k, soft AND (coalesce((SELECT err FROM s x WHERE x.user_id = r.user_id AND x.pos = edge.a - 1), false) OR coalesce((SELECT err FROM s x WHERE x.user_id = r.user_id AND x.pos = edge.b + 1), false)) AS tainted
  FROM r LEFT JOIN edge ON soft AND edge.user_id = r.user_id AND edge.g = r.g)"""


@query(f"WITH {_SQL_EDITS} SELECT ['sil', 'fix', 'ins', 'sub', 'cor', 'cor'][k + 1] AS edit_type, count(*) AS n, count(*) FILTER (tainted) AS tainted FROM m GROUP BY 1")
def taint_statistics(t):
    """Edits by type, and how many of them stand next to errors."""
    kinds = F.get(F.array(*map(F.lit, ("sil", "fix", "ins", "sub", "cor", "cor"))), (F.col("event_id") % 6).cast("int"))
    e = t.events.select("user_id", "event_id", F.struct("ts", "event_id").alias("pos"), kinds.alias("edit_type"), F.lit(False).alias("oov"))
    return S.tainted(e, "user_id", "pos").groupBy("edit_type").agg(F.count("*").alias("n"), F.count_if("tainted").alias("tainted"))


@query()
def letter_confusions(t):
    """Letters set against each other in local alignments of neighbouring turns (dynamic programming: no SQL)."""
    w = W.partitionBy("conv_id").orderBy("turn")
    p = t.conversations.withColumn("other", F.lag("text").over(w)).filter("other IS NOT NULL").select("conv_id", F.col("text").alias("a"), F.col("other").alias("b")).repartition(tasks(t.spark))
    return p.select(F.explode(E.letter_pairs(p, "a", "b")).alias("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n"))


# Sequences


@query("""WITH s AS (SELECT event_id, user_id % 10 AS rec, epoch_us(ts) / 1000000.0 AS a, epoch_us(ts) / 1000000.0 + value * 300 AS b FROM events),
 o AS (SELECT *, max(b) OVER (PARTITION BY rec ORDER BY a, b DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
 n AS (SELECT *, lag(b) OVER w AS pe, lead(a) OVER w AS na FROM o WHERE reach IS NULL OR b > reach WINDOW w AS (PARTITION BY rec ORDER BY a, b DESC, event_id)),
 w AS (SELECT *, unnest([0, 1, 2, 3]) AS k FROM n), m AS (SELECT *, (b - a) * k / 4 AS off, a + (b - a) * k / 4 + (b - a) / 8 AS mid FROM w)
 SELECT event_id, k AS word, round(a + off, 3) AS start FROM m WHERE (pe IS NULL OR pe <= a OR mid >= (pe + a) / 2) AND (na IS NULL OR na >= b OR mid < (na + b) / 2)""")
def words_without_overlap(t):
    """Words of overlapping segments, each once; segments inside an earlier one give none."""
    s = t.events.select(F.col("event_id").alias("utt"), (F.col("user_id") % 10).alias("recording"), seconds_of(F.col("ts")).alias("start"), (seconds_of(F.col("ts")) + F.col("value") * 300).alias("end"))
    words = s.select("utt", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("word"), (F.col("end") - F.col("start")).alias("d")).select("utt", "word", (F.col("d") * F.col("word") / 4).alias("start"), (F.col("d") / 4).alias("dur"))
    return S.without_overlap(words, s).select(F.col("utt").alias("event_id"), "word", F.round("start", 3).alias("start"))


@query("""WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame, event_type IN ('click', 'view') AS speech FROM events),
 g AS (SELECT *, frame - row_number() OVER (PARTITION BY user_id, speech ORDER BY frame) AS grp FROM f),
 r AS (SELECT user_id, min(frame) * 0.03 AS a, (max(frame) + 1) * 0.03 AS b FROM g WHERE speech GROUP BY user_id, grp HAVING (max(frame) + 1 - min(frame)) * 0.03 >= 0.06 - 1e-9),
 n AS (SELECT *, lag(b) OVER w AS p, lead(a) OVER w AS x FROM r WINDOW w AS (PARTITION BY user_id ORDER BY a))
 SELECT user_id, CAST(round(greatest(0, a - 0.05, coalesce(least(p + 0.05, a), 0)), 4) AS DOUBLE) AS start, CAST(round(least(b + 0.05, coalesce(x, b + 0.05)), 4) AS DOUBLE) AS "end" FROM n""")
def speech_segments(t):
    """Runs of speech frames: long enough, and padded as far as the next run."""
    w = W.partitionBy("user_id").orderBy("event_id")
    frames = t.events.select("user_id", (F.row_number().over(w) - 1).alias("frame"), F.when(F.col("event_type").isin("click", "view"), "speech").otherwise("silence").alias("label"))
    return S.speech_segments(frames, "user_id", 0.03, "speech", 0.06, 0.05).select("user_id", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"))


@query("SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'fix' WHEN event_id % 3 = 0 THEN 'ins' ELSE 'cor' END AS edit_type, event_type AS hyp FROM events")
def forgiven_edits(t):
    """Errors that concern only words that are not scored become fixes."""
    e = t.events.select("event_id", F.col("event_type").alias("hyp"), F.col("event_type").alias("ref"), F.when(F.col("event_id") % 3 == 0, "ins").otherwise("cor").alias("edit_type"))
    return E.forgiven(e, ["error"]).select("event_id", "edit_type", "hyp")


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos, event_type FROM events),
 x AS (SELECT *, event_type = 'error' AS bad FROM e), g AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id, bad ORDER BY pos) AS grp FROM x),
 r AS (SELECT user_id, (min(pos) - 1) * 0.3 AS a, max(pos) * 0.3 AS b, string_agg(event_type, ' ' ORDER BY pos) AS text FROM g WHERE NOT bad GROUP BY user_id, grp HAVING count(*) * 0.3 >= 0.5),
 n AS (SELECT *, lag(b) OVER w AS p, lead(a) OVER w AS x FROM r WINDOW w AS (PARTITION BY user_id ORDER BY a))
 SELECT user_id, CAST(round(greatest(0, a - least(0.05, coalesce((a - p) / 2, 0.05))), 4) AS DOUBLE) AS start, CAST(round(b + least(0.05, coalesce((x - b) / 2, 0.05)), 4) AS DOUBLE) AS "end", text FROM n""")
def clean_segments(t):
    """Segments around runs of words without an error, padded by no more than half of what lies between."""
    pos = F.row_number().over(W.partitionBy("user_id").orderBy("event_id"))
    e = t.events.select("user_id", pos.alias("pos"), F.col("event_type").alias("ref"), F.when(F.col("event_type") == "error", "sub").otherwise("cor").alias("edit_type"), F.lit(False).alias("tainted"))
    e = e.withColumn("start", (F.col("pos") - 1) * 0.3).withColumn("dur", F.lit(0.3))
    return E.clean_cores(e, "user_id", "pos").select("user_id", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"), "text")


@query("""WITH RECURSIVE u AS (SELECT l_suppkey AS speaker, l_orderkey, l_linenumber, l_quantity AS d, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem),
 f AS (SELECT speaker, l_orderkey, l_linenumber, rn, d AS open, 0 AS part FROM u WHERE rn = 1
  UNION ALL SELECT u.speaker, u.l_orderkey, u.l_linenumber, u.rn, CASE WHEN f.open + u.d > 300 THEN u.d ELSE f.open + u.d END, CASE WHEN f.open + u.d > 300 THEN f.part + 1 ELSE f.part END FROM f JOIN u ON u.speaker = f.speaker AND u.rn = f.rn + 1)
 SELECT l_orderkey, l_linenumber, speaker || '-' || lpad(CAST(part AS VARCHAR), 3, '0') AS part FROM f""")
def speaker_parts_by_seconds(t):
    """Speakers cut into runs of at most so many seconds; a run that would be longer begins anew."""
    d = t.lineitem.select(F.col("l_suppkey").cast("string").alias("speaker"), F.struct("l_orderkey", "l_linenumber").alias("k"), F.col("l_quantity").alias("dur"))
    return S.split_speakers_by_seconds(d, "speaker", "k", "dur", 300.0).select("k.l_orderkey", "k.l_linenumber", "part")


# Texts and names


@query()
def word_edits(t):
    """Edit distance in words of neighbouring turns (the other engine's distance counts bytes: no SQL)."""
    words = X.words(F.lower("text"))
    p = t.conversations.select("conv_id", "turn", words.alias("a")).withColumn("b", F.lag("a").over(W.partitionBy("conv_id").orderBy("turn"))).filter("b IS NOT NULL")
    return p.select("conv_id", "turn", E.word_distance(F.col("a"), F.col("b")).cast("long").alias("distance"))


@query("""SELECT c_custkey, round(jaro_winkler_similarity(c_mktsegment, n_name), 6) AS winkler, round(1 - levenshtein(c_mktsegment, n_name) / greatest(length(c_mktsegment), length(n_name)), 6) AS edit,
 round(list_sum(list_transform(range(1, least(length(c_mktsegment), length(n_name)) + 1), lambda i: (substr(c_mktsegment, i, 1) = substr(n_name, i, 1))::INT)) / greatest(length(c_mktsegment), length(n_name)), 6) AS places FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def name_similarities(t):
    """Three similarities of two names, from 0 to 1."""
    p = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name")
    s = E.similarities(p, "c_mktsegment", "n_name", ("jaro_winkler", "levenshtein", "hamming"))
    return p.select("c_custkey", s.alias("s")).select("c_custkey", F.round("s.jaro_winkler", 6).alias("winkler"), F.round("s.levenshtein", 6).alias("edit"), F.round("s.hamming", 6).alias("places"))


@query()
def sound_similarities(t):
    """Similarities by sound and by weighted n-grams (letter groups and dynamic programming: no SQL)."""
    p = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name")
    return p.select("c_custkey", E.similarities(p, "c_mktsegment", "n_name", ("editex", "mra", "wng")).alias("s")).select("c_custkey", "s.*")


@query("SELECT page_id, replace(replace(concat_ws('-', 'a b', url), ' ', '_'), '/', '_') AS name, (CASE WHEN page_id % 3 = 0 THEN 'gs://' || url ELSE url END) LIKE 'gs://%' AS remote FROM pages")
def joined_names(t):
    """Names of recordings made from identifiers, and which addresses are those of a store."""
    place = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("gs://"), "url")).otherwise(F.col("url"))
    return t.pages.select("page_id", X.utterance_name(F.lit("a b"), F.col("url")).alias("name"), X.is_remote(place).alias("remote"))


@query(r"SELECT doc_id, md5(lower(trim(regexp_replace(regexp_replace(translate(replace(text, 'ß', 'ss'), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ', 'aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY'), '[^\x00-\x7F]', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')))) AS digest FROM documents")
def plain_texts(t):
    """ASCII texts on one line, in lower case."""
    return t.documents.select("doc_id", F.md5(X.plain(F.col("text")).cast("binary")).alias("digest"))


@query("SELECT o_orderkey, round(CASE WHEN n = 1 THEN 1 ELSE pow(i * 1.0 / (n - 1) - 0.5, 2) * 4 END, 6) AS centre, round(CASE WHEN n = 1 THEN 1 ELSE pow(i * 1.0 / (n - 1), 2) END, 6) AS rising, round(CASE WHEN n = 1 THEN 1 ELSE pow(i * 1.0 / (n - 1) - 1, 2) END, 6) AS falling FROM (SELECT o_orderkey, o_orderkey % 7 + 1 AS n, o_orderkey % (o_orderkey % 7 + 1) AS i FROM orders)")
def place_weights(t):
    """Quadratic weights by place: least in the middle, rising, falling."""
    n = F.col("o_orderkey") % 7 + 1
    d = t.orders.select("o_orderkey", n.alias("n"), (F.col("o_orderkey") % n).alias("i"))
    return d.select("o_orderkey", *[F.round(X.centre_weight(F.col("i"), F.col("n"), k), 6).alias(name) for name, k in (("centre", 0), ("rising", 1), ("falling", -1))])


_SQL_COUNTS = f"t AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({SQL_WORDS}) AS term FROM benchmark) GROUP BY ALL), p AS (SELECT item_id, sum(n) AS total, max(n) AS most FROM t GROUP BY 1), w AS (SELECT term, count(*) AS c FROM t GROUP BY 1), d AS (SELECT count(*) AS docs FROM benchmark)"


@query(f"WITH {_SQL_COUNTS} SELECT item_id, round(sum(1 + ln(n)), 4) AS log_tf, round(sum((0.5 + 0.5 * n / most) * ln(1 + docs / c)), 4) AS normalised, round(sum(n / total * CASE WHEN c < docs THEN ln((docs - c) / c) ELSE 0 END), 4) AS probabilistic FROM t JOIN p USING (item_id) JOIN w USING (term), d GROUP BY item_id")
def term_weights(t):
    """Term weights under several schemes of frequency and of rarity, summed by text."""
    sums = lambda name, tf, idf: C.tf_idf(t.benchmark, "item_id", "text", 1, tf, idf).groupBy("item_id").agg(F.round(F.sum(F.when(F.col("weight") > float("-inf"), F.col("weight")).otherwise(0.0)), 4).alias(name))
    return sums("log_tf", "log", "unary").join(sums("normalised", "normalized", "log-smoothed"), "item_id").join(sums("probabilistic", "share", "probabilistic"), "item_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type AS kind FROM events")
def annotated_json(t):
    """A field set in a JSON object, and read again with the others."""
    made = X.with_key(F.col("props"), "kind", F.col("event_type"))
    m = t.events.select("event_id", X.as_map(made).alias("m"))
    return m.select("event_id", F.col("m")["k"].cast("int").alias("k"), F.col("m")["kind"].alias("kind"))


@query("SELECT lang, count(DISTINCT source) AS kinds FROM documents GROUP BY lang")
def merged_values(t):
    """Lists of values merged, each value once."""
    lists = t.documents.groupBy("lang", (F.col("doc_id") % 4).alias("part")).agg(F.collect_set("source").alias("s"))
    return lists.groupBy("lang").agg(F.size(X.merged_unique(F.collect_list("s"))).cast("long").alias("kinds"))


@query("""WITH a AS (SELECT vec_id, [abs(embedding[1])::DOUBLE, abs(embedding[2])::DOUBLE, abs(embedding[3])::DOUBLE] AS x, [abs(embedding[4])::DOUBLE, abs(embedding[5])::DOUBLE, abs(embedding[6])::DOUBLE] AS y FROM embeddings),
 s AS (SELECT vec_id, list_transform(x, lambda v: v / list_sum(x)) AS p, list_transform(y, lambda v: v / list_sum(y)) AS q FROM a)
 SELECT vec_id, CASE WHEN list_max(p) > 0.5 AND list_max(q) > 0.5 AND list_position(p, list_max(p)) = list_position(q, list_max(q)) THEN round((p[1] + q[1]) / 2, 6) ELSE 0.0 END AS first,
  list_max(p) > 0.5 AND list_max(q) > 0.5 AND list_position(p, list_max(p)) = list_position(q, list_max(q)) AS sure FROM s""")
def merged_targets(t):
    """Two sets of class shares merged where both are sure and agree on the class; nothing otherwise."""
    part = lambda a: F.transform(F.slice("embedding", a, 3), lambda v: F.abs(v.cast("double")))
    share = lambda c: F.transform(c, lambda v: v / F.aggregate(c, F.lit(0.0), lambda s, x: s + x))
    d = t.embeddings.select("vec_id", part(1).alias("x"), part(4).alias("y")).select("vec_id", share(F.col("x")).alias("p"), share(F.col("y")).alias("q"))
    m = d.select("vec_id", X.merged_targets(F.col("p"), F.col("q")).alias("m"))
    return m.select("vec_id", F.round(F.get("m", F.lit(0)), 6).alias("first"), (F.aggregate("m", F.lit(0.0), lambda s, x: s + x) > 0).alias("sure"))


# Samples


@query("SELECT doc_id, CASE WHEN u * 10 < 5 THEN 'rain' WHEN u * 10 < 8 THEN 'wind' ELSE 'street' END AS item FROM (SELECT doc_id, CAST(('0x' || substr(md5('pick/' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM documents)")
def weighted_picks(t):
    """An item for each row by weight, the same at every run."""
    return R.weighted_pick(t.documents.select("doc_id"), F.col("doc_id"), [("rain", 5), ("wind", 3), ("street", 2)])


@query("SELECT doc_id FROM documents WHERE CAST(('0x' || substr(md5('sample/' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.25")
def sampled_rows(t):
    """A quarter of the rows, the same at every run."""
    return R.sampled(t.documents.select("doc_id"), "doc_id", 0.25)


@query("SELECT source, CAST(floor(n0 / (1 + n0 / n)) AS BIGINT) AS rows FROM (SELECT source, count(*) AS n, 2.58 * 2.58 * 0.25 / (0.01 * 0.01) AS n0 FROM documents GROUP BY source)")
def sample_sizes(t):
    """Rows that estimate a share within one per cent, for each source."""
    n = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    return n.select("source", R.sample_rows(F.col("n")).alias("rows"))


@query("""WITH p AS (SELECT p_brand AS word, p_type AS pron, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT DISTINCT p_brand AS word, p_type AS pron FROM part WHERE p_size = 1),
 w AS (SELECT word, count(*) AS own FROM r GROUP BY word), m AS (SELECT ceil(avg(own)) AS mean FROM w),
 x AS (SELECT p.*, ceil(2 * coalesce(own, mean)) AS most, row_number() OVER (PARTITION BY p.word ORDER BY n DESC, pron DESC) AS rn FROM p LEFT JOIN w USING (word), m WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.word = p.word AND r.pron = p.pron))
 SELECT word, pron FROM x WHERE rn > most""")
def pruned_pronunciations(t):
    """Pronunciations beyond twice as many new ones as the reference lexicon has for the word."""
    prons = t.part.groupBy(F.col("p_brand").alias("word"), F.col("p_type").alias("pron")).agg(F.count("*").cast("double").alias("prob"))
    return C.pruned_prons(prons, t.part.filter("p_size = 1").select(F.col("p_brand").alias("word"), F.col("p_type").alias("pron")), 2.0)


_SQL_BIASED = """l AS (SELECT user_id AS k, list_concat(['<s>'], list(event_type ORDER BY event_id), ['</s>']) AS w FROM events GROUP BY user_id, event_id // 2000),
 g AS (SELECT k, w[greatest(1, i - 2):i - 1] AS h, w[i] AS word FROM (SELECT k, w, unnest(range(2, len(w) + 1)) AS i FROM l)),
 c AS (SELECT k, h, word, count(*)::DOUBLE AS c FROM g GROUP BY ALL), met AS (SELECT k, h, sum(c) AS met FROM c WHERE len(h) = 2 GROUP BY ALL),
 few AS (SELECT c.* FROM c JOIN met USING (k, h) WHERE met < 3),
 c3 AS (SELECT c.* FROM c WHERE len(h) = 2 AND NOT EXISTS (SELECT 1 FROM few f WHERE f.k = c.k AND f.h = c.h)),
 c2 AS (SELECT k, h, word, sum(c) AS c FROM (SELECT * FROM c WHERE len(h) = 1 UNION ALL SELECT k, h[2:], word, c FROM few UNION ALL SELECT k, h[2:], word, 1.0 FROM c3) GROUP BY ALL),
 c1 AS (SELECT k, word, sum(c) AS c FROM (SELECT k, word, c FROM c WHERE len(h) = 0 UNION ALL SELECT k, word, 1.0 FROM c2) GROUP BY ALL),
 p1 AS (SELECT k, word, c / sum(c) OVER (PARTITION BY k) AS p FROM c1),
 p2 AS (SELECT c2.k, h, c2.word, (c - 0.3) / sum(c) OVER v + 0.3 * count(*) OVER v / sum(c) OVER v * p1.p AS p FROM c2 JOIN p1 ON p1.k = c2.k AND p1.word = c2.word WINDOW v AS (PARTITION BY c2.k, h)),
 p3 AS (SELECT c3.k, c3.h, c3.word, (c - 0.3) / sum(c) OVER v + 0.3 * count(*) OVER v / sum(c) OVER v * p2.p AS p FROM c3 JOIN p2 ON p2.k = c3.k AND p2.h = c3.h[2:] AND p2.word = c3.word WINDOW v AS (PARTITION BY c3.k, c3.h))"""


@query(f"""WITH {_SQL_BIASED} SELECT k AS user_id, '' AS history, word, CAST(floor(p * 1000000 + 0.4137) AS BIGINT) AS millionths FROM p1 UNION ALL SELECT k, array_to_string(h, ' '), word, CAST(floor(p * 1000000 + 0.4137) AS BIGINT) FROM p2 UNION ALL SELECT k, array_to_string(h, ' '), word, CAST(floor(p * 1000000 + 0.4137) AS BIGINT) FROM p3""")
def biased_models(t):
    """A three-gram model of each user's own lines of events, rare histories backed off."""
    lines = R.collected(t.events.withColumn("part", F.floor(F.col("event_id") / 2000)).withColumn("line", F.struct("user_id", "part")), "line", "event_type", ["event_id"], name="text").select("line.user_id", "text")
    m = C.biased_model(lines, "user_id", "text", order=3, least=3)
    return m.select("user_id", F.array_join("history", " ").alias("history"), "word", F.floor(F.col("p") * 1000000 + 0.4137).alias("millionths"))


@query("""WITH a AS (SELECT c_custkey AS o_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'test' ELSE 'dev' END AS split FROM customer WHERE c_custkey % 500 < 2), o AS (SELECT o_orderkey, o_custkey FROM orders),
 h AS (SELECT count(*) FILTER (split = 'test') AS t, count(*) FILTER (split = 'dev') AS d FROM o JOIN a USING (o_custkey)),
 s AS (SELECT o_custkey, count(*) AS n FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM a) GROUP BY 1), c AS (SELECT o_custkey, sum(n) OVER (ORDER BY n, o_custkey ROWS UNBOUNDED PRECEDING) AS cum FROM s)
 SELECT o_orderkey, split FROM o JOIN a USING (o_custkey) UNION ALL SELECT o_orderkey, CASE WHEN cum <= greatest(0, 100 - t) THEN 'test' WHEN cum <= greatest(0, 100 - t) + greatest(0, 200 - d) THEN 'dev' ELSE 'train' END FROM o JOIN c USING (o_custkey), h""")
def assigned_split(t):
    """Orders split by customer, some customers given beforehand."""
    from corpusflow.operators import splits as P

    given = t.customer.filter("c_custkey % 500 < 2").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, "test").otherwise("dev").alias("split"))
    return P.entity_split(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 100, 200, given).select("o_orderkey", "split")


@query()
def balanced_speakers(t):
    """Orders in eight parts of like size, no customer in two (edges moved over step by step: no SQL)."""
    from corpusflow.operators import splits as P

    return P.balanced_split(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 8).groupBy("part").agg(F.count("*").alias("n"), F.min("o_custkey").alias("first"), F.max("o_custkey").alias("last"))


_ONES = "['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve', 'thirteen', 'fourteen', 'fifteen', 'sixteen', 'seventeen', 'eighteen', 'nineteen']"
_TENS = "['twenty', 'thirty', 'forty', 'fifty', 'sixty', 'seventy', 'eighty', 'ninety']"


@query(f"""WITH n AS (SELECT o_orderkey, o_orderkey % 1000 AS n FROM orders), w AS (SELECT o_orderkey, n, CASE WHEN n % 100 >= 20 THEN {_TENS}[n % 100 // 10 - 1] || CASE WHEN n % 10 > 0 THEN '-' || {_ONES}[n % 10 + 1] ELSE '' END
 WHEN n % 100 > 0 OR n = 0 THEN {_ONES}[n % 100 + 1] ELSE '' END AS low, CASE WHEN n >= 100 THEN {_ONES}[n // 100 + 1] || ' hundred' ELSE '' END AS high FROM n),
 x AS (SELECT o_orderkey, n, trim(high || ' ' || low) AS words FROM w)
 SELECT o_orderkey, 'Pay ' || words || CASE WHEN n = 1 THEN ' dollar' ELSE ' dollars' END || ' and five cents for ' || words || ' point five tons' AS text FROM x""")
def spoken_numbers(t):
    """Sentences with numbers and money as they are read."""
    n = (F.col("o_orderkey") % 1000).cast("string")
    d = t.orders.select("o_orderkey", F.concat(F.lit("Pay $"), n, F.lit(".05  for\n"), n, F.lit(".5 tons")).alias("text"))
    return d.select("o_orderkey", E.spoken_column(d, "text").alias("text"))


@query()
def repeated_words(t):
    """Inserted words that repeat their neighbours become correct (gone through in order: no SQL)."""
    kind = F.when(F.col("event_id") % 3 == 0, "ins").otherwise("cor")
    e = t.events.select(F.col("user_id").alias("utt"), F.struct("ts", "event_id").alias("pos"), F.col("event_type").alias("hyp"), F.when(kind == "cor", F.col("event_type")).alias("ref"), kind.alias("edit_type"))
    return E.repetitions_fixed(e).groupBy("edit_type").agg(F.count("*").alias("n"))


def _measured():
    return lambda data: f"{len(data)} bytes"


def _initials():
    return lambda texts: [t[:1].lower() or None for t in texts]


@query("SELECT page_id, strlen(html) || ' bytes' AS transcript FROM pages")
def recognised_recordings(t):
    """A recogniser as a plug-in: a function of a recording's bytes, made once a worker."""
    from corpusflow.operators import models

    return models.transcribed(t.pages.select("page_id", F.col("html").cast("binary").alias("content")), "content", _measured, ["page_id"])


@query("SELECT conv_id, turn, lower(substr(text, 1, 1)) AS label FROM conversations")
def classified_texts(t):
    """A classifier as a plug-in: a function of a list of texts."""
    from corpusflow.operators import models

    return t.conversations.select("conv_id", "turn", models.labelled(t.conversations, "text", _initials).alias("label"))


@query(r"SELECT tag, count(*) AS n FROM (SELECT 'PERCENT' AS tag, unnest(regexp_extract_all(html, '[0-9]+(\.[0-9]+)?\s*%')) FROM pages UNION ALL SELECT 'YEAR', unnest(regexp_extract_all(html, '20[0-9][0-9]')) FROM pages) GROUP BY tag")
def entity_counts(t):
    """Entities that patterns find, by kind."""
    from corpusflow.operators import models

    found = models.entities(t.pages, "page_id", "html", {"PERCENT": r"[0-9]+(?:\.[0-9]+)?\s*%", "YEAR": r"20[0-9][0-9]"})
    return found.groupBy("tag").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, 'conversation' AS domain, 'web' AS collected FROM documents")
def annotated_rows(t):
    """Constant values on all rows."""
    from corpusflow.plans import stages

    return stages.annotate(t.documents.select("doc_id", "lang"), {"domain": "conversation", "collected": "web"})

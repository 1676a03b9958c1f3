"""Timed edits of utterances, and the segments that are made of them.

An edit line is (utt, pos, start, dur, hyp, ref, edit_type, tainted): a word or silence of the recogniser's output with its
time, the reference's word set against it (``<eps>`` where there is none), and what the two make: cor, sub, ins, del, sil or fix.

``segments_of`` works on rows: an utterance's lines are numbered and get, by windows that run once in either direction,
what a segment that begins or ends there needs to know (running counts, the nearest place to cut before and after).  A segment is then
a row with its first and last line, so that each stage is an expression over one row; no stage gathers an utterance.
Utterances are the unit of the windows, and may be as long as they like.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.functions import kernels
from corpusflow.functions.arrow import by_row
from corpusflow.session import ship

EPS = "<eps>"


def merged_edits(words: DataFrame, pairs: DataFrame, key: str = "utt", order: str = "pos", oov: str | None = None, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """Edit lines from timed words (utt, pos, start, dur, word) and aligned words without times (utt, pos, hyp, ref).

    The words that both have (all but ``<eps>``) must be the same in the same order; an utterance where they aren't is an
    error.  After each of them come the deletions, at its end and with no duration, and then the silences.  Before the first,
    deletions are at the start of the first timed word, or at 0 where there is none.  With ``vocabulary``, ``oov`` against a
    word outside it is correct.  An utterance that only one side has is kept if that side has nothing but ``<eps>``.
    """
    w = W.partitionBy(key).orderBy(order)
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    heard = F.col("word") != EPS
    t = words.select(key, F.col(order).alias("o"), "start", "dur", "word").withColumn("k", F.count_if(F.col("word") != EPS).over(W.partitionBy(key).orderBy("o").rowsBetween(W.unboundedPreceding, W.currentRow)))
    p = pairs.select(key, order, "hyp", "ref").withColumn("k", F.count_if(F.col("hyp") != EPS).over(so_far)).withColumnRenamed(order, "o")
    spoken = t.filter(heard).select(key, "k", F.col("start").alias("start"), F.col("dur").alias("dur"), "word")
    told = p.filter(F.col("hyp") != EPS).select(key, "k", "hyp", "ref")
    both = spoken.join(told, [key, "k"], "full")
    fits = F.when(F.col("word") == F.col("hyp"), F.col("hyp")).otherwise(F.raise_error(F.concat(F.lit("words and edits differ in "), F.col(key).cast("string"))).cast("string"))
    none = F.lit(0.0)
    matched = both.select(key, "k", F.lit(0).alias("class"), F.lit(None).cast(p.schema["o"].dataType).alias("o"), "start", "dur", fits.alias("hyp"), "ref")
    begun = t.groupBy(key).agg(F.min_by("start", "o").alias("first"))
    ends = spoken.select(key, "k", (F.col("start") + F.col("dur")).alias("end"))
    gone = p.filter(F.col("hyp") == EPS).join(ends, [key, "k"], "left").join(begun, key, "left")
    gone = gone.select(key, "k", F.lit(1).alias("class"), "o", F.coalesce("end", "first", none).alias("start"), none.alias("dur"), F.lit(EPS).alias("hyp"), "ref")
    quiet = t.filter(~heard).select(key, "k", F.lit(2).alias("class"), F.col("o").cast(p.schema["o"].dataType).alias("o"), "start", "dur", F.lit(EPS).alias("hyp"), F.lit(EPS).alias("ref"))
    rows = matched.unionByName(gone).unionByName(quiet)
    number = F.row_number().over(W.partitionBy(key).orderBy("k", "class", "o")) - 1
    return rows.select(key, number.alias("pos"), "start", "dur", "hyp", "ref", edit_type(F.col("hyp"), F.col("ref"), F.col("dur"), oov, vocabulary).alias("edit_type"))


def edit_type(hyp: Column, ref: Column, dur: Column, oov: str | None = None, vocabulary: Sequence[str] | None = None) -> Column:
    known = F.lit(False) if not vocabulary or oov is None else (hyp == oov) & ~ref.isin(*vocabulary)
    kind = F.when((hyp == ref) & (hyp != EPS), "cor").when((hyp != EPS) & (ref == EPS), "ins").when((hyp == EPS) & (ref != EPS) & (dur == 0), "del")
    return kind.when(known, "cor").when((hyp == EPS) & (ref == EPS), "sil").otherwise("sub")


def locally_aligned(df: DataFrame, ref: str, words: str, correct: int = 1, substitution: int = 1, deletion: int = 1, insertion: int = 1, whole_hyp: bool = True, first_pair: bool = False) -> Column:
    """array<edit line>: the local alignment of each row's ``words`` (array of start, dur, word; silences are ``<eps>``) to ``ref`` (words).

    A deletion lies at the end of the word before it, with no duration; a silence that is set against a word is that word's deletion
    and then the silence.  Alignments are of rows one by one (``kernels.local_words``); null counts as empty.
    """
    ship(df.sparkSession)
    from pyspark.sql.functions import arrow_udf

    fields = [("start", pa.float64()), ("dur", pa.float64()), ("hyp", pa.string()), ("ref", pa.string()), ("edit_type", pa.string())]

    def lines(told: list[str], said: list[dict]) -> list[dict]:
        out, now = [], said[0]["start"] if said else 0.0
        path, _ = kernels.local_words(told, [x["word"] for x in said], correct, substitution, deletion, insertion, whole_hyp, first_pair)
        for i, j in path:
            word = None if i is None else told[i]
            if j is None or (said[j]["word"] == EPS and word is not None):
                out.append((now, 0.0, EPS, word, "del"))
            if j is None:
                continue
            x = said[j]
            silent = x["word"] == EPS
            out.append((x["start"], x["dur"], x["word"], EPS if silent or word is None else word, "sil" if silent else "ins" if word is None else "cor" if word == x["word"] else "sub"))
            now = x["start"] + x["dur"]
        return [dict(zip((f for f, _ in fields), row, strict=True)) for row in out]

    @arrow_udf("array<struct<start:double,dur:double,hyp:string,ref:string,edit_type:string>>")
    def run(refs: pa.Array, heard: pa.Array) -> pa.Array:
        return by_row(lambda r, h: lines(r or [], h or []), pa.list_(pa.struct(fields)), refs, heard)

    return run(F.col(ref), F.col(words))


@dataclass(frozen=True)
class SegmentRules:
    """Lengths in seconds; a new segment is one that is not its whole utterance."""

    unscored: tuple[str, ...] = ()
    unknown: str = "<unk>"
    least: float = 0.5
    least_new: float = 1.0
    frame: float = 0.01
    edge_silence: float = 0.5
    edge_unscored: float = 0.5
    inner_silence: float = 2.0
    inner_unscored: float = 2.0
    padding: float = 0.05
    junk: float = 0.1
    cut_from: float = 0.1
    kept_deletions: int = 1


#: What a segment knows of its first and last line.
LINE = ("i", "start", "dur", "kind", "tainted", "unscored", "good", "goods", "dels", "is_del", "next_cut", "last_cut")


def numbered_lines(edits: DataFrame, rules: SegmentRules, key: str = "utt", order: str = "pos") -> DataFrame:
    """(utt, i, line, ref, core, run, stop): the lines with all that the stages ask of them."""
    w = W.partitionBy(key).orderBy("i")
    up = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    down = W.partitionBy(key).orderBy(F.desc("i"))
    unscored = F.col("ref").isin(*rules.unscored) if rules.unscored else F.lit(False)
    d = edits.select(key, (F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).alias("i"), F.col("start").cast("double").alias("start"), F.col("dur").cast("double").alias("dur"), "hyp", "ref", F.col("edit_type").alias("kind"), F.coalesce("tainted", F.lit(False)).alias("tainted"))
    d = d.withColumn("unscored", F.coalesce(unscored, F.lit(False))).withColumn("same", F.coalesce(F.col("hyp") == F.col("ref"), F.lit(False)))
    seed = (F.col("kind") == "cor") & F.col("same")
    d = d.withColumn("good", seed & ~F.col("unscored")).withColumn("is_del", F.col("kind") == "del")
    d = d.withColumn("seed", seed).withColumn("able", seed | (~F.col("tainted") & F.col("kind").isin("cor", "sil", "fix")))
    cut = F.when(((F.col("kind") == "sil") | ((F.col("kind") == "cor") & F.col("unscored"))) & (F.col("dur") > rules.cut_from), F.struct("i", "start", "dur", "kind", "tainted", "unscored", "good", "goods", "dels", "is_del"))
    d = d.withColumn("goods", F.count_if("good").over(up)).withColumn("dels", F.count_if("is_del").over(up))
    d = d.withColumn("last_cut", F.last(cut, True).over(w.rowsBetween(W.unboundedPreceding, -1))).withColumn("next_cut", F.last(cut, True).over(down.rowsBetween(W.unboundedPreceding, -1)))
    stop = ((F.col("kind") == "sil") & (F.col("dur") > rules.inner_silence)) | (F.col("unscored") & (F.col("dur") > rules.inner_unscored))
    d = d.withColumn("turn", F.coalesce((F.col("able") != F.lag("able").over(w)).cast("int"), F.lit(0)))
    d = d.withColumn("line", F.struct(*LINE)).withColumn("stop", stop)
    last = F.last(F.col("start") + F.col("dur")).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return d.withColumn("run", F.sum("turn").over(up)).withColumn("before", F.lag("line").over(w)).withColumn("after", F.lead("line").over(w)).withColumn("utt_end", last)


def cores(lines: DataFrame, key: str = "utt") -> DataFrame:
    """Stages 0 and 1: runs of lines without errors and with a correct word, and a tainted neighbour of a correct word at either end."""
    runs = lines.filter("able").groupBy(key, "run").agg(F.min_by("line", "i").alias("first"), F.max_by("line", "i").alias("last"), F.min_by("before", "i").alias("before"), F.max_by("after", "i").alias("after"), F.max("seed").alias("seed"), F.max("utt_end").alias("utt_end"), F.collect_list(F.when(F.col("stop"), F.col("line"))).alias("stops"))
    grown = lambda edge, beside: F.when((F.col(f"{edge}.kind") == "cor") & F.coalesce(F.col(f"{beside}.tainted"), F.lit(False)), F.col(beside)).otherwise(F.col(edge))
    return runs.filter("seed").select(key, grown("first", "before").alias("first"), grown("last", "after").alias("last"), "utt_end", "stops")


def split_at_stops(segments: DataFrame, key: str = "utt") -> DataFrame:
    """Stage 2: cut in the middle of long silences and unscored words inside; both parts have the line, and half of its time."""
    inside = F.array_sort(F.filter("stops", lambda x: (x["i"] > F.col("first.i")) & (x["i"] < F.col("last.i"))))
    edges = F.concat(F.array("first"), inside, F.array("last"))
    pieces = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda k: F.struct(F.get(edges, k - 1).alias("first"), F.get(edges, k).alias("last"), F.when(k > 1, 0.5).otherwise(1.0).alias("keep_first"), F.when(k < F.size(edges) - 1, 0.5).otherwise(1.0).alias("keep_last")))
    return segments.select(key, "utt_end", F.inline(pieces)).withColumn("pad_first", F.lit(0.0)).withColumn("pad_last", F.lit(0.0))


def settled(df: DataFrame) -> DataFrame:
    """The same rows; what comes after takes the columns as they are, and isn't rewritten into what they are made of."""
    return df.select(F.inline(F.array(F.struct(*(F.col(c) for c in df.columns)))))


def begin() -> Column:
    return F.col("first.start") + F.col("first.dur") - F.col("pad_first") - F.col("first.dur") * F.col("keep_first")


def end() -> Column:
    return F.col("last.start") + F.col("last.dur") * F.col("keep_last") + F.col("pad_last")


def length() -> Column:
    return end() - begin()


def truncate_edges(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stage 3: of long silences and unscored words at the ends no more than the longest allowed is kept."""

    def kept(edge: str) -> Column:
        dur = F.col(f"{edge}.dur")
        most = F.when((F.col(f"{edge}.kind") == "sil") & (dur > rules.edge_silence), rules.edge_silence).when(F.col(f"{edge}.unscored") & (dur > rules.edge_unscored), rules.edge_unscored)
        return F.coalesce(most / dur, F.col(f"keep_{edge}"))

    return segments.withColumns({f"keep_{e}": kept(e) for e in ("first", "last")})


def relax_edges(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stage 4: a segment that truncation has made too short gets so much back that it has the least length, but nothing of a tainted line."""
    cutoff = F.lit(max(rules.least, rules.least_new))
    loose = {e: F.when(F.col(f"{e}.tainted"), F.col(f"keep_{e}")).otherwise(1.0) for e in ("first", "last")}
    full = F.col("last.start") + F.col("last.dur") * F.col("loose_last") - (F.col("first.start") + F.col("first.dur") - F.col("first.dur") * F.col("loose_first"))
    d = segments.withColumns({f"loose_{e}": c for e, c in loose.items()}).withColumns({"now": length(), "full": full})
    short = ((F.col("keep_first") != 1.0) | (F.col("keep_last") != 1.0)) & (F.col("now") < cutoff)
    a = F.when(F.col("full") > cutoff, (cutoff - F.col("full")) / F.when(F.col("now") != F.col("full"), F.col("now") - F.col("full"))).otherwise(0.0)
    d = d.withColumn("a", F.when(short, a))
    ok = F.col("a").between(0.0, 1.0)
    return d.withColumns({f"keep_{e}": F.when(ok, F.col("a") * F.col(f"keep_{e}") + (1 - F.col("a")) * F.col(f"loose_{e}")).when(short, F.col(f"loose_{e}")).otherwise(F.col(f"keep_{e}")) for e in ("first", "last")}).drop("loose_first", "loose_last", "now", "full", "a")


def pad_edges(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stage 5: beyond a correct scored word at an end the unknown word is added, as far as the utterance goes, and half of it at least."""
    room = {"first": F.col("first.start"), "last": F.col("utt_end") - (F.col("last.start") + F.col("last.dur"))}
    pad = lambda e: F.least(F.lit(rules.padding), room[e])
    able = lambda e: (F.col(f"{e}.kind") == "cor") & ~F.col(f"{e}.unscored") & (pad(e) >= 0.5 * rules.padding)
    return segments.withColumns({f"pad_{e}": F.when(able(e), pad(e)).otherwise(0.0) for e in ("first", "last")})


def drop_short(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stages 6 and 7; a thousandth is allowed for rounding."""
    whole = (F.abs(begin()) < 0.001) & (F.abs(end() - F.col("utt_end")) < 0.001)
    return segments.filter((whole | (length() >= 0.999 * rules.least_new)) & (length() >= 0.999 * rules.least))


def _junk(edge: str) -> Column:
    return F.col(f"pad_{edge}") + F.when(F.col(f"{edge}.tainted"), F.col(f"{edge}.dur") * F.col(f"keep_{edge}")).otherwise(0.0)


def _as_line(cut: str) -> Column:
    """A place to cut as a line of a segment; it needs no places of its own any more."""
    return F.struct(*(F.col(f"{cut}.{c}").alias(c) for c in LINE[:-2]), F.lit(None).cast(CUT).alias("next_cut"), F.lit(None).cast(CUT).alias("last_cut"))


CUT = "struct<i:int,start:double,dur:double,kind:string,tainted:boolean,unscored:boolean,good:boolean,goods:bigint,dels:bigint,is_del:boolean>"


def cut_junk(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stages 8 and 9: what lies outside the first, then the last, silence or unscored word inside goes if it has too much junk."""
    d = segments
    for edge, cut in (("first", "next_cut"), ("last", "last_cut")):
        at = f"{edge}.{cut}"
        inside = (F.col(f"{at}.i") > F.col("first.i")) & (F.col(f"{at}.i") < F.col("last.i"))
        gone = F.col(f"{at}.start") - begin() if edge == "first" else end() - (F.col(f"{at}.start") + F.col(f"{at}.dur"))
        hit = F.coalesce(inside & (_junk(edge) != 0) & (gone != 0), F.lit(False))
        hit &= F.coalesce(_junk(edge) / F.when(hit, gone) >= rules.junk, F.lit(False))
        d = d.withColumn("hit", hit).withColumns({f"pad_{edge}": F.when(F.col("hit"), 0.0).otherwise(F.col(f"pad_{edge}")), f"keep_{edge}": F.when(F.col("hit"), 1.0).otherwise(F.col(f"keep_{edge}")), edge: F.when(F.col("hit"), _as_line(at)).otherwise(F.col(edge))}).drop("hit")
        d = settled(d)
    return d


def worth_keeping(segments: DataFrame, rules: SegmentRules) -> DataFrame:
    """Stages 10 and 11: with a correct scored word, and no more than the allowed share of junk."""
    goods = F.col("last.goods") - F.col("first.goods") + F.col("first.good").cast("long")
    return segments.filter((goods > 0) & ((_junk("first") + _junk("last")) / F.when(length() != 0, length()) <= rules.junk))


def merge_touching(segments: DataFrame, rules: SegmentRules, key: str = "utt") -> DataFrame:
    """Stage 12: (utt, n, first, last, begin, end, pad_first, pad_last, dropped) of segments that overlap or touch, as one.

    ``dropped``: (a, b) of lines between two of them whose deleted words don't come into the text, since they are too many.
    """
    w = W.partitionBy(key).orderBy("first.i", "last.i")
    d = segments.withColumns({"begin": begin(), "end": end()}).withColumn("prev", F.lag(F.struct("end", "last")).over(w))
    joined = F.coalesce(F.col("prev.end") >= F.col("begin"), F.lit(False))
    one, two = F.col("prev.last"), F.col("first")
    low, high = F.when(one["i"] <= two["i"], one).otherwise(two), F.when(one["i"] <= two["i"], two).otherwise(one)
    many = high["dels"] - low["dels"] + low["is_del"].cast("long") > rules.kept_deletions
    d = d.withColumn("joined", joined).withColumn("gap", F.when(joined & many, F.struct(low["i"].alias("a"), high["i"].alias("b"))))
    d = d.withColumn("n", F.count_if(~F.col("joined")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    by = F.struct("first.i", "last.i")
    return d.groupBy(key, "n").agg(F.min("first.i").alias("first"), F.max_by("last.i", by).alias("last"), F.min_by("begin", by).alias("begin"), F.max_by("end", by).alias("end"), F.min_by("pad_first", by).alias("pad_first"), F.max_by("pad_last", by).alias("pad_last"), F.collect_list("gap").alias("dropped"))


def segment_rows(lines: DataFrame, rules: SegmentRules = SegmentRules(), key: str = "utt") -> DataFrame:
    """All stages over ``numbered_lines``: the rows of ``merge_touching``."""
    d = split_at_stops(cores(lines, key), key)
    for stage in (truncate_edges, relax_edges, pad_edges, drop_short, cut_junk, worth_keeping):
        d = settled(stage(d, rules))
    return merge_touching(d, rules, key)


def segments_of(edits: DataFrame, rules: SegmentRules = SegmentRules(), key: str = "utt", order: str = "pos") -> DataFrame:
    """(utt, n, segment, start, end, text): the segments of each utterance, in order, with names that end in their numbers."""
    lines = numbered_lines(edits, rules, key, order)
    d = segment_rows(lines, rules, key)
    at = d.select(key, "n", "dropped", F.explode(F.sequence("first", "last")).alias("i"))
    words = at.join(lines.filter(F.col("ref") != EPS).select(key, "i", "ref", "is_del"), [key, "i"])
    words = words.filter(~(F.col("is_del") & F.exists("dropped", lambda x: F.col("i").between(x["a"], x["b"]))))
    said = words.groupBy(key, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "ref"))), lambda x: x["ref"]).alias("said"))
    unknown = lambda e: F.when(F.col(f"pad_{e}") != 0, F.array(F.lit(rules.unknown))).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(unknown("first"), F.coalesce("said", F.array().cast("array<string>")), unknown("last")), " ")
    digits = F.length(F.count("*").over(W.partitionBy(key)).cast("string"))
    name = F.concat(F.col(key).cast("string"), F.lit("-"), F.lpad(F.col("n").cast("string"), digits, "0"))
    on_frame = lambda c: F.round(F.rint(F.col(c) / F.lit(rules.frame)) * F.lit(rules.frame), 6)
    return d.join(said, [key, "n"], "left").select(key, "n", name.alias("segment"), on_frame("begin").alias("start"), on_frame("end").alias("end"), text.alias("text"))


def words_outside(edits: DataFrame, segments: DataFrame, key: str = "utt") -> DataFrame:
    """(word, n, outside, badness): how often each reference word lies in no segment, the most troublesome first by ``outside^3 / n^2``.

    ``segments`` are those of ``merge_touching``; ``edits`` those of ``numbered_lines``.
    """
    inside = segments.select(key, F.explode(F.sequence("first", "last")).alias("i")).distinct().withColumn("inside", F.lit(True))
    d = edits.filter(F.col("ref") != EPS).select(key, "i", "ref").join(inside, [key, "i"], "left")
    per = d.groupBy(F.col("ref").alias("word")).agg(F.count("*").alias("n"), F.count_if(F.col("inside").isNull()).alias("outside"))
    return per.withColumn("badness", F.pow("outside", F.lit(3)) / F.pow("n", F.lit(2)))

"""Operators over ordered rows: fragments, segments, runs, overlaps, coverage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.operators.relational import numbered
from corpusflow.session import tasks


def sessions(df: DataFrame, key: str, start: str, end: str, gap: float, tie: str) -> DataFrame:
    """Rows numbered by session: a new one where a row begins more than ``gap`` after the row before ended."""
    w = W.partitionBy(key).orderBy(start, tie)
    new = F.coalesce((F.col(start) - F.lag(end).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("__new", new).withColumn("session", F.sum("__new").over(w)).drop("__new")


def fragments(words: Column, longest_ms: int = 15_000, longest_silence_ms: int = 3_000) -> Column:
    """array<struct(start, end, transcript)> from ordered words (start_ms, end_ms, word).

    A word opens a new fragment if with it the fragment would be longer than ``longest_ms``, or if the
    silence before it is longer than ``longest_silence_ms``.  A fold, since the first rule starts anew
    at each cut; no Python.
    """
    one = lambda w: F.struct(w["start_ms"].alias("start"), w["end_ms"].alias("end"), F.array(w["word"]).alias("words"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,words:array<string>>>")

    def step(acc: Column, w: Column) -> Column:
        last = acc["open"]
        cut = (w["end_ms"] - last["start"] > longest_ms) | (w["start_ms"] - last["end"] > longest_silence_ms)
        grown = F.struct(last["start"].alias("start"), w["end_ms"].alias("end"), F.concat(last["words"], F.array(w["word"])).alias("words"))
        return F.struct(F.when(cut, F.concat(acc["done"], F.array(last))).otherwise(acc["done"]).alias("done"), F.when(cut, one(w)).otherwise(grown).alias("open"))

    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    folded = F.aggregate(rest, F.struct(empty.alias("done"), one(F.get(words, F.lit(0))).alias("open")), step, lambda acc: F.concat(acc["done"], F.array(acc["open"])))
    return F.transform(F.when(F.size(words) > 0, folded).otherwise(empty), lambda x: F.struct(x["start"], x["end"], F.array_join(x["words"], " ").alias("transcript")))


def extended(segments: DataFrame, before: float = 0.1, after: float = 0.1, past_end: float = 0.1, recording: str = "recording", key: str = "utt") -> DataFrame:
    """Segments (utt, recording, start, end) padded on both sides, where two then overlap both to the middle.

    Starts stay at 0 or above, ends at most ``past_end`` beyond the recording's last end; what has no length goes.
    """
    w = W.partitionBy(recording).orderBy((F.col("start") + F.col("end")) / 2, key)
    s = segments.withColumn("s", F.greatest(F.lit(0.0), F.col("start") - before)).withColumn("e", F.least(F.max("end").over(W.partitionBy(recording)) + past_end, F.col("end") + after))
    s = s.withColumn("pe", F.lag("e").over(w)).withColumn("ns", F.lead("s").over(w))
    s = s.withColumn("start", F.when(F.col("pe") > F.col("s"), (F.col("pe") + F.col("s")) / 2).otherwise(F.col("s"))).withColumn("end", F.when(F.col("ns") < F.col("e"), (F.col("ns") + F.col("e")) / 2).otherwise(F.col("e")))
    return s.filter("start < end").select(*segments.columns)


def uniform_windows(duration: Column, window: float = 30.0, overlap: float = 5.0, rest: float = 10.0) -> Column:
    """array<struct(start, end)>: windows that overlap; a rest of at most ``rest`` joins the last one.

    Window i begins at i * (window - overlap); the last one is the first whose end has at most ``rest`` beyond it.
    """
    step = window - overlap
    n = F.greatest(F.lit(0), F.ceil((duration - window - rest) / step)).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((i * step).alias("start"), F.when(i == n, duration).otherwise(F.least(duration, i * step + window)).alias("end")))


def split_documents(words: Column, most: int = 1000) -> Column:
    """Word arrays of like size, none of more than ``most`` words; ``words`` should be a column."""
    n = F.size(words)
    docs = F.floor(n / F.lit(most)) + 1
    shift = (F.floor(n / docs) + 1).cast("int")
    parts = F.transform(F.sequence(F.lit(0), (docs - 1).cast("int")), lambda i: F.slice(words, i * shift + 1, shift))
    return F.filter(parts, lambda p: F.size(p) > 0)


def runs(df: DataFrame, key: str, order: str, label: str) -> DataFrame:
    """Maximal runs of one label: key, label, first and last place, rows (gaps and islands)."""
    w = W.partitionBy(key).orderBy(order)
    change = F.coalesce((F.col(label) != F.lag(label).over(w)).cast("int"), F.lit(0))
    marked = df.withColumn("__c", change).withColumn("run", F.sum("__c").over(w))
    return marked.groupBy(key, "run", label).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def adjacent_overlap(df: DataFrame, key: str, tie: str) -> DataFrame:
    """By how much each interval runs into the next one of its key; 0 where it does not."""
    w = W.partitionBy(key).orderBy("start", "end", tie)
    return df.withColumn("overlap", F.greatest(F.lit(0.0), F.coalesce(F.col("end") - F.lead("start").over(w), F.lit(0.0))))


def without_overlap(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Words (utt, start, dur, word in segment time) of overlapping segments (utt, recording, start, end), each once.

    A segment that lies inside an earlier one gives no word, and the earlier one is left whole.  Of a pair of neighbours that
    overlap, the earlier keeps words whose middle lies before the middle of the overlap, the later the others.
    """
    w = W.partitionBy("recording").orderBy("start", F.desc("end"), "utt")
    reach = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    outer = segments.withColumn("__reach", reach).filter(F.col("__reach").isNull() | (F.col("end") > F.col("__reach")))
    cut = outer.withColumn("to", F.lead("start").over(w)).withColumn("from", F.lag("end").over(w))
    cut = cut.select("utt", "recording", F.col("start").alias("base"), F.when(F.col("from") > F.col("start"), (F.col("from") + F.col("start")) / 2).alias("from"), F.when(F.col("to") < F.col("end"), (F.col("to") + F.col("end")) / 2).alias("to"))
    mid = F.col("base") + F.col("start") + F.col("dur") / 2
    kept = words.join(cut, "utt").filter((F.col("from").isNull() | (mid >= F.col("from"))) & (F.col("to").isNull() | (mid < F.col("to"))))
    return kept.select("recording", (F.col("base") + F.col("start")).alias("start"), "dur", "word", "utt")


def tainted(edits: DataFrame, key: str = "utt", order: str = "pos", remove_deletions: bool = False) -> DataFrame:
    """Edits with ``tainted``: runs of silence, fixes and unknown words next to an error, on either side.

    With ``remove_deletions``, deletions that taint a neighbour go: that says all that they say.

    edit_type is one of cor, sub, ins, del, sil, fix; ``oov`` marks correct unknown words.
    """
    w = W.partitionBy(key).orderBy(order)
    soft = F.col("edit_type").isin("sil", "fix") | ((F.col("edit_type") == "cor") & F.col("oov"))
    error = F.col("edit_type").isin("ins", "del", "sub")
    d = edits.withColumn("__soft", F.coalesce(soft, F.lit(False))).withColumn("__error", error)
    turn = F.coalesce((F.col("__soft") != F.lag("__soft").over(w)).cast("int"), F.lit(0))
    d = d.withColumn("__t", turn).withColumn("__run", F.sum("__t").over(w)).withColumn("__before", F.lag("__error").over(w)).withColumn("__after", F.lead("__error").over(w))
    own = W.partitionBy(key, "__run").orderBy(order)
    whole = own.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    edge = F.coalesce(F.first("__before").over(whole), F.lit(False)) | F.coalesce(F.last("__after").over(whole), F.lit(False))
    told = d.withColumn("tainted", F.col("__soft") & edge)
    if remove_deletions:
        beside = F.coalesce(F.lag("__soft").over(w), F.lit(False)) | F.coalesce(F.lead("__soft").over(w), F.lit(False))
        told = told.withColumn("__gone", (F.col("edit_type") == "del") & beside).filter(~F.col("__gone"))
    return told.select(*edits.columns, "tainted")


def coverage_range(df: DataFrame, value: str, outside: float = 0.05, least: float = 0.3) -> DataFrame:
    """(low, high): the smallest and largest values left when ``outside`` of the total is cut off at either end."""
    up, down = W.orderBy(value), W.orderBy(F.desc(value))
    counts = df.groupBy(value).agg(F.sum(value).alias("mass"))
    total = F.sum("mass").over(W.partitionBy())
    c = counts.withColumn("up", F.sum("mass").over(up) / total).withColumn("down", F.sum("mass").over(down) / total)
    return c.agg(F.greatest(F.lit(least), F.min(F.when(F.col("up") > outside, F.col(value)))).alias("low"), F.max(F.when(F.col("down") > outside, F.col(value))).alias("high"))


def yearly_cumulative(df: DataFrame, date: Column, seconds: Column) -> DataFrame:
    """Seconds of each year, and hours up to its end."""
    y = df.groupBy(F.year(date).alias("year")).agg(F.sum(seconds).alias("seconds"))
    return y.withColumn("cumulative_hours", F.sum("seconds").over(W.orderBy("year")) / 3600.0)


def combined(durations: list[float], least: float) -> list[tuple[int, int]]:
    """Neighbours merged until every piece is at least ``least`` long, if that can be: (first, end) of each piece.

    From the right, a short piece joins the neighbour with which it is long enough; of two such the shorter one,
    and the one after it if they are alike or neither will do.  Differences up to 1e-5 don't count.
    """
    less = lambda x, y: x < y - 1e-5
    pieces, done = [(i, i + 1, d) for i, d in enumerate(durations)], []  # up to the one that is looked at; those after it, the next one last
    while pieces and len(pieces) + len(done) > 1:
        start, end, own = pieces[-1]
        if not less(own, least):
            done.append(pieces.pop())
            continue
        before, after = pieces[-2][2] if len(pieces) > 1 else None, done[-1][2] if done else None
        enough_before = before is not None and not less(before + own, least)
        enough_after = after is not None and not less(after + own, least)
        to_left = after is None or (before is not None and enough_before and (not enough_after or less(before, after)))
        if to_left:
            pieces.pop()
            pieces[-1] = (pieces[-1][0], end, before + own)
        else:
            pieces[-1] = (start, done.pop()[1], own + after)
    return [(a, b) for a, b, _ in pieces + done[::-1]]


def _seconds(dur: pa.ChunkedArray) -> tuple[list[float], np.ndarray]:
    """Durations, NaN for null, and what they add to sums."""
    d = dur.to_numpy()
    return d.tolist(), np.nan_to_num(d, nan=0.0, posinf=np.inf, neginf=-np.inf)


def combine_utterances(df: DataFrame, least: float, speaker: str = "speaker", key: str = "utt") -> DataFrame:
    """Utterances (speaker, utt, dur) merged within a speaker, in order of key: (speaker, name, members, dur)."""

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([(key, "ascending"), ("dur", "ascending")])  # one order, whatever order the rows came in
        durations, seconds = _seconds(group.column("dur"))
        ids, spans = group.column(key).to_pylist(), combined(durations, least)
        names = [ids[a] if b == a + 1 else f"{ids[a]}-comb{b - a}" for a, b in spans]
        sums = [float(seconds[a:b].sum()) for a, b in spans]
        own = group.column(speaker).combine_chunks().slice(0, 1).to_pylist() * len(spans)
        columns = [pa.array(own, pa.string()), pa.array(names, pa.string()), pa.array([ids[a:b] for a, b in spans], pa.list_(pa.string())), pa.array(sums, pa.float64())]
        return pa.Table.from_arrays(columns, names=[speaker, "name", "members", "dur"])

    rows = df.select(F.col(speaker).cast("string").alias(speaker), F.col(key).cast("string").alias(key), F.col("dur").cast("double")).repartition(tasks(df.sparkSession), speaker)
    return rows.groupBy(speaker).applyInArrow(merge, f"{speaker} string, name string, members array<string>, dur double")


def combine_across_speakers(df: DataFrame, least: float, speaker: str = "speaker", key: str = "utt") -> DataFrame:
    """Utterances merged within a speaker, and what is still short then with its neighbours in the order of (speaker, utt): (name, speaker, members, dur).

    Only what is too short looks for a neighbour, so two neighbours that are both long enough never meet: the order is cut between them,
    and each stretch is merged on its own.  A stretch is short utterances with single long ones between and around them; only where
    speaker after speaker is too short as a whole does it grow.  The name is the first member's and their number; the
    speaker is the one with the most seconds, of equals (to 1e-5) the first by name.
    """
    within = combine_utterances(df, least, speaker, key)
    placed = numbered(within.withColumn("__first", F.col("members")[0]), [speaker, "__first"], "__place")
    placed = placed.withColumn("__long", ~(F.col("dur") < least - 1e-5))
    before = placed.select((F.col("__place") + 1).alias("__place"), F.col("__long").alias("__before"))
    cut = placed.join(before, "__place", "left").withColumn("__cut", (F.col("__long") & F.coalesce("__before", F.lit(False))).cast("long"))
    stretch = numbered(cut, ["__place"], "__again", "__stretch", "__cut").withColumn("__stretch", F.col("__stretch") + F.col("__cut"))
    sizes = stretch.groupBy("__stretch").agg(F.count("*").alias("__n"))
    stretch = stretch.join(sizes, "__stretch").select("__stretch", "__n", "__place", speaker, "members", "dur")
    alone = stretch.filter("__n = 1").select(F.when(F.size("members") == 1, F.col("members")[0]).otherwise(F.concat(F.col("members")[0], F.lit("-comb"), F.size("members").cast("string"))).alias("name"), speaker, "members", "dur")

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("__place")
        durations, sums = _seconds(group.column("dur"))
        members, who_said, rows = group.column("members").to_pylist(), group.column(speaker).to_pylist(), []
        for a, b in combined(durations, least):
            ids = [m for part in members[a:b] for m in part]
            seconds: dict[str, float] = {}
            for who, d in zip(who_said[a:b], durations[a:b], strict=True):
                seconds[who] = seconds.get(who, 0.0) + d
            best = None
            for who in sorted(seconds):
                best = who if best is None or seconds[best] < seconds[who] - 1e-5 else best
            rows.append((ids[0] if len(ids) == 1 else f"{ids[0]}-comb{len(ids)}", best, ids, float(sums[a:b].sum())))
        kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.float64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["name", speaker, "members", "dur"])

    several = stretch.filter("__n > 1").repartition(tasks(df.sparkSession), "__stretch")
    return alone.unionByName(several.groupBy("__stretch").applyInArrow(merge, f"name string, {speaker} string, members array<string>, dur double"))


def split_speakers(df: DataFrame, speaker: str, key: str, most: int) -> DataFrame:
    """Speakers cut into runs of at most ``most`` utterances, numbered with leading zeros."""
    rn = F.row_number().over(W.partitionBy(speaker).orderBy(key)) - 1
    return df.withColumn("part", F.format_string("%s-%03d", F.col(speaker), F.floor(rn / F.lit(most)).cast("int")))


def split_speakers_by_seconds(df: DataFrame, speaker: str, key: str, duration: str, most: float) -> DataFrame:
    """Speakers cut into runs of at most ``most`` seconds: an utterance that would make a run longer begins the next one.

    The sum starts anew at each cut, so a speaker's durations (numbers alone) are folded in order, as the sorted rows of a
    partition come in: a task holds a batch of rows, however many a speaker has.
    """
    kinds = dict(df.dtypes)
    rows = df.select(speaker, key, F.col(duration).cast("double").alias("__d")).repartition(speaker).sortWithinPartitions(speaker, key, "__d")

    def cut(batches):
        import pyarrow as pa

        begun, own, part, held = False, None, 0, 0.0
        for batch in batches:
            parts = []
            for who, d in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not begun or who != own:
                    begun, own, part, held = True, who, 0, d
                elif held + d > most:
                    part, held = part + 1, d
                else:
                    held += d
                parts.append(f"{who}-{part:03d}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.string())], names=[speaker, key, "part"])

    return rows.mapInArrow(cut, f"{speaker} {kinds[speaker]}, {key} {kinds[key]}, part string")


def speech_segments(frames: DataFrame, key: str, frame_s: float, speech: str, least: float = 0.0, pad: float = 0.0, most: float = 0.0) -> DataFrame:
    """Speech runs of frame labels (key, frame, label) that are long enough, padded on both sides.

    Padding ends at the next run; what it leaves of the silence the next run's padding may take.  With ``most``, segments that
    then touch are put together while they are no longer than that.
    """
    r = runs(frames, key, "frame", "label").filter(F.col("label") == speech)
    s = r.select(key, (F.col("first") * frame_s).alias("start"), ((F.col("last") + 1) * frame_s).alias("end")).filter(F.col("end") - F.col("start") >= least - 1e-9)
    w = W.partitionBy(key).orderBy("start")
    s = s.withColumn("p", F.lag("end").over(w)).withColumn("n", F.lead("start").over(w))
    low = F.greatest(F.lit(0.0), F.col("start") - pad, F.coalesce(F.least(F.col("p") + pad, F.col("start")), F.lit(0.0)))
    high = F.least(F.col("end") + pad, F.coalesce("n", F.col("end") + pad))
    out = s.select(key, low.alias("start"), high.alias("end"))
    return merged_touching(out, key, most) if most > 0 else out


def merged_touching(segments: DataFrame, key: str, most: float) -> DataFrame:
    """Segments (key, start, end) of which each that begins where the one before ends joins it, up to ``most`` in all.

    Where one ends depends on all joined before, so the numbers of each run of touching segments are gone through in order.
    """
    w = W.partitionBy(key).orderBy("start", "end")
    turn = F.coalesce((F.col("start") != F.lag("end").over(w)).cast("int"), F.lit(1))
    run = segments.withColumn("__run", F.sum(turn).over(w)).groupBy(key, "__run").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    kind = dict(segments.dtypes)[key]

    def join(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for who, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kept = []
                for x in own:
                    if kept and x["end"] - kept[-1][1] <= most:
                        kept[-1][2] = x["end"]
                    else:
                        kept.append([who, x["start"], x["end"]])
                rows += kept
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field(0).type, pa.float64(), pa.float64()), strict=True)], names=[key, "start", "end"])

    return run.select(key, "s").mapInArrow(join, f"{key} {kind}, start double, end double")

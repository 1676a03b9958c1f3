"""Filters, joins, aggregations, set operations, sampling and sharding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.session import written

# Filters


def usable_files(files: DataFrame, size: str = "size", private: str = "private", names: Sequence[str] = ("identifier", "name")) -> DataFrame:
    """Files with a size other than 0 (one that is no number counts as none), not private, without brackets in their names."""
    keep = (F.col(size).try_cast("bigint") != 0) & F.col(private).isNull()
    for n in names:
        keep &= ~F.contains(F.col(n), F.lit("[")) & ~F.contains(F.col(n), F.lit("]"))
    return files.filter(keep)


def gate_reason(gates: Mapping[str, tuple[float | None, float | None]]) -> Column:
    """The first named number outside its bounds, as ``name too low`` or ``name too high``; null if all hold."""
    out = None
    for name, (low, high) in gates.items():
        for bound, bad, word in ((low, F.col(name) < F.lit(low), "low"), (high, F.col(name) > F.lit(high), "high")):
            if bound is not None:
                reason = F.lit(f"{name} too {word}")
                out = F.when(bad, reason) if out is None else out.when(bad, reason)
    return out if out is not None else F.lit(None).cast("string")


def gate_counts(df: DataFrame, gates: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """reason and rows; rows that pass count under ``kept``."""
    return df.groupBy(F.coalesce(gate_reason(gates), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def drop_where(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which a SQL expression is not true."""
    return df.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def by_ids(df: DataFrame, ids: DataFrame, on: str, exclude: bool = False) -> DataFrame:
    """Rows whose ``on`` is, or is not, among ``ids``."""
    return df.join(ids, on, "left_anti" if exclude else "left_semi")


def without_unknown(df: DataFrame, vocabulary: DataFrame, *cols: str) -> DataFrame:
    """Rows all of whose ``cols`` are in the one-column ``vocabulary`` (nulls are not)."""
    for c in cols:
        df = df.join(vocabulary.toDF("__known").withColumnRenamed("__known", c), c, "left_semi").select(*df.columns)
    return df


def cap_repeats(df: DataFrame, by: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each value, exactly."""
    rn = F.row_number().over(W.partitionBy(by).orderBy(order))
    return df.withColumn("__rn", rn).filter(F.col("__rn") <= most).drop("__rn")


def thin_repeats(df: DataFrame, by: str, key: str, most: int, seed: str = "thin") -> DataFrame:
    """All rows of values that occur up to ``most`` times; of others each with probability most / n, by a seeded digest."""
    n = df.groupBy(by).agg(F.count("*").alias("__n")).withColumnRenamed(by, "__by")
    chance = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col(key).cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.join(n, F.col(by).eqNullSafe(F.col("__by"))).filter((F.col("__n") <= most) | (chance < F.lit(float(most)) / F.col("__n"))).select(*df.columns)


def frequent(df: DataFrame, by: str, more_than: int) -> DataFrame:
    """Rows of groups with more than so many rows: groups are counted and joined back, so no group is gathered."""
    n = df.groupBy(by).agg(F.count("*").alias("__n")).filter(F.col("__n") > more_than).select(F.col(by).alias("__by"))
    return df.join(n, F.col(by).eqNullSafe(F.col("__by")), "left_semi")


def permitted(df: DataFrame, grants: DataFrame, on: str, who: str, owner: str | None = None) -> DataFrame:
    """Rows that ``who`` may see: those granted (on, who), to ``*`` too, and one's own."""
    seen = df.join(grants.filter(F.col("who").isin(who, "*")).select(on).distinct().withColumn("__granted", F.lit(True)), on, "left")
    free = F.col("__granted").isNotNull()
    return seen.filter(free | (F.col(owner) == who) if owner else free).select(*df.columns)


def weighted_pick(df: DataFrame, key: Column, items: Sequence[tuple[str, float]], seed: str = "pick", name: str = "item") -> DataFrame:
    """An item for each row with a chance in proportion to its weight, by a seeded digest of ``key``; weights need not add up to 1."""
    total, upto, out = sum(w for _, w in items), 0.0, None
    chance = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), key.cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    for item, weight in items:
        upto += weight
        hit = chance * total < F.lit(upto)
        out = F.when(hit, F.lit(item)) if out is None else out.when(hit, F.lit(item))
    return df.withColumn(name, out.otherwise(F.lit(items[-1][0])))


def sampled(df: DataFrame, key: str, share: float, seed: str = "sample") -> DataFrame:
    """Each row with probability ``share``, by a seeded digest of its key."""
    chance = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col(key).cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.filter(chance < share)


def sample_rows(population: Column, z: float = 2.58, error: float = 0.01, share: float = 0.5) -> Column:
    """Rows that estimate a share within ``error`` at confidence ``z``, of a finite population (see ``kernels.sample_size``)."""
    n = z * z * share * (1 - share) / (error * error)
    return F.when(population > 0, F.floor(F.lit(n) / (1 + F.lit(n) / population))).otherwise(F.lit(0)).cast("long")


# Joins


def held_out(df: DataFrame, on: Sequence[str], *others: DataFrame) -> DataFrame:
    """Rows that none of the other frames has by ``on``."""
    for o in others:
        df = df.join(o.select(*on).distinct(), list(on), "left_anti")
    return df


def overlap(hyp: DataFrame, ref: DataFrame, key: str = "file") -> DataFrame:
    """Seconds by which intervals (key, start, end) of two frames overlap, a row a pair that does.

    Time is cut into buckets as wide as the mean interval, so that an interval has two rows on average; a pair is met in each
    bucket that both touch and taken in the one where the later of the two begins.  A key with all intervals is as many keys as it has buckets.
    """
    size = [d.agg(F.sum(F.abs(F.col("end") - F.col("start"))).cast("double"), F.count("*")).first() for d in (hyp, ref)]
    width = sum(x[0] or 0.0 for x in size) / max(1, sum(x[1] for x in size)) or 1.0
    bucket = lambda c: F.floor(c.cast("double") / F.lit(width))
    cut = lambda d: d.withColumn("__bucket", F.explode(F.sequence(bucket(F.least("start", "end")), bucket(F.greatest("start", "end")))))
    h = cut(hyp.select(key, "start", "end")).select(key, "__bucket", F.col("start").alias("h_start"), F.col("end").alias("h_end"))
    r = cut(ref.select(key, "start", "end")).select(key, "__bucket", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    both = h.join(r, [key, "__bucket"]).filter("h_start < r_end AND r_start < h_end").filter(F.col("__bucket") == bucket(F.greatest("h_start", "r_start")))
    return both.drop("__bucket").withColumn("seconds", F.least("h_end", "r_end") - F.greatest("h_start", "r_start"))


def segmentation_scores(hyp: DataFrame, ref: DataFrame, key: str = "file", short: float = 0.2, long: float = 60.0) -> DataFrame:
    """Per key: seconds hypothesised, found and falsely alarmed, and counts of short and long hypotheses."""
    found = overlap(hyp, ref, key).groupBy(key).agg(F.sum("seconds").alias("found"))
    d = F.col("end") - F.col("start")
    own = hyp.groupBy(key).agg(F.sum(d).alias("hypothesised"), F.count_if(d < short).alias("n_short"), F.count_if(d > long).alias("n_long"))
    return own.join(found, key, "left").select(key, "hypothesised", F.coalesce("found", F.lit(0.0)).alias("found"), (F.col("hypothesised") - F.coalesce("found", F.lit(0.0))).alias("false_alarm"), "n_short", "n_long")


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """(last bound at or below, first bound at or above) of a value among sorted bounds; null beyond them."""
    b = F.array(*[F.lit(float(x)) for x in bounds])
    return F.struct(F.array_max(F.filter(b, lambda x: x <= value)).alias("below"), F.array_min(F.filter(b, lambda x: x >= value)).alias("above"))


def map_tokens(df: DataFrame, key: str, tokens: str, mapping: DataFrame, unknown: str) -> DataFrame:
    """Tokens replaced through ``mapping`` (token, to) in order; those without one become ``unknown``."""
    flat = df.select(key, F.posexplode_outer(tokens).alias("pos", "token")).join(mapping, "token", "left")
    to = F.when(F.col("token").isNotNull(), F.coalesce("to", F.lit(unknown)))
    return flat.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", to.alias("to"))))).alias("t")).select(key, F.transform("t", lambda x: x["to"]).alias(tokens))


def by_position(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """Rows of equal key put side by side in order."""
    number = lambda df, order: df.withColumn("place", F.row_number().over(W.partitionBy(key).orderBy(order)))
    return number(left, left_order).join(number(right, right_order), [key, "place"])


# Aggregations


def shares(df: DataFrame, by: str) -> DataFrame:
    """Count and share of each value."""
    return df.groupBy(by).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def hours_by(df: DataFrame, by: Column, seconds: Column, name: str = "kind") -> DataFrame:
    """Hours and rows of each kind."""
    return df.groupBy(by.alias(name)).agg((F.sum(seconds) / 3600.0).alias("hours"), F.count("*").alias("n"))


def array_hours(df: DataFrame, durations_ms: Column) -> DataFrame:
    """Hours over arrays of milliseconds, without exploding them."""
    total = F.aggregate(durations_ms, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    return df.agg((F.sum(total) / 1000.0 / 60.0 / 60.0).alias("hours"))


def class_histogram(df: DataFrame, scores: str, scale: float = 1.0, ranks: tuple[int, int] = (1, 1 << 30)) -> DataFrame:
    """Sum of positive scores of each class in a map column, scaled, those of the ranks asked for."""
    flat = df.select(F.explode(scores).alias("label", "score")).filter("score > 0")
    total = flat.groupBy("label").agg((F.sum("score") * scale).alias("total"))
    return total.withColumn("rank", F.row_number().over(W.orderBy(F.desc("total"), "label"))).filter(F.col("rank").between(*ranks))


def histogram_percentiles(df: DataFrame, value: str, count: str, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """For each fraction f: the smallest value whose running count reaches int(f * total)."""
    w = W.partitionBy(*by).orderBy(value)
    run = df.withColumn("cum", F.sum(count).over(w)).withColumn("total", F.sum(count).over(W.partitionBy(*by)))
    return run.groupBy(*by).agg(*[F.min(F.when(F.col("cum") >= F.floor(F.lit(f) * F.col("total")), F.col(value))).alias(f"p{round(f * 100)}") for f in fractions])


def bucketed(df: DataFrame, columns: Sequence[str], weight: str, overflow: int = 100) -> DataFrame:
    """(metric, bucket, n, total weight) of several numbers in one pass: whole-number buckets, one for all above ``overflow``."""
    flat = df.select(weight, F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])))
    bucket = F.when(F.col("value") > overflow, F.lit(f">{overflow}")).otherwise(F.floor("value").cast("string"))
    return flat.filter("value IS NOT NULL").groupBy("metric", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum(weight).alias("total"))


def extremes(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Total, mean, and the keys of the largest and the smallest value (the first key on ties)."""
    d = df.select(F.col(key).alias("k"), value.alias("v"))
    return d.agg(F.sum("v").alias("total"), F.avg("v").alias("mean"), F.min_by("k", F.struct(-F.col("v"), F.col("k"))).alias("longest"), F.min_by("k", F.struct("v", "k")).alias("shortest"))


def collected(df: DataFrame, key: str, value: str, order: Sequence[str], sep: str = " ", name: str = "joined") -> DataFrame:
    """Values of each key joined in order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__value"))))
    return df.groupBy(key).agg(F.array_join(F.transform(rows, lambda x: x["__value"]), sep).alias(name))


def dominant(df: DataFrame, key: str, member: str, weight: str) -> DataFrame:
    """The member of each key with the largest total weight, the first by name on ties."""
    total = df.groupBy(key, member).agg(F.sum(weight).alias("total"))
    return total.groupBy(key).agg(F.min_by(member, F.struct(-F.col("total"), F.col(member))).alias(member), F.max("total").alias("total"))


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """The frame and metrics that are there once it has been written: no extra pass."""
    seen = Observation(name)
    return df.observe(seen, *metrics), seen


# Set operations


def first_of(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key, the first in order."""
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("__rn = 1").drop("__rn")


def merged(*frames: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union in which an earlier frame wins a key; keys are unique in each frame."""
    ranked = None
    for i, f in enumerate(frames):
        f = f.withColumn("__rank", F.lit(i))
        ranked = f if ranked is None else ranked.unionByName(f)
    return first_of(ranked, by, ["__rank"]).drop("__rank")


def consistent(*frames: DataFrame, on: str) -> list[DataFrame]:
    """Each frame with only the keys that all of them have."""
    out = []
    for i, f in enumerate(frames):
        for j, other in enumerate(frames):
            if i != j:
                f = f.join(other.select(on).distinct(), on, "left_semi")
        out.append(f)
    return out


# Order, samples and shards


def digest_order(*cols: Column, seed: str = "") -> Column:
    """A fixed shuffle: the md5 of seed and key."""
    return F.md5(F.concat_ws("/", F.lit(seed), *[c.cast("string") for c in cols]).cast("binary"))


def numbered(df: DataFrame, order: Sequence[str], place: str = "place", total: str | None = None, value: str | None = None) -> DataFrame:
    """``place``: how many rows come before in the order of ``order``; with ``total`` also the sum of ``value`` over these.

    Rows are sorted by range over as many partitions as the session shuffles to, and written with their partition and their place
    in it; what comes before a partition is added up from one row for each.  Columns in ``order`` should tell all rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = written(ranged.withColumn("__at", F.monotonically_increasing_id())).withColumn("__range", F.shiftright("__at", 33))
    sums = [F.count("*").alias("__n")] + ([F.sum(value).alias("__v")] if total else [])
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    of_range = at.groupBy("__range").agg(*sums)
    of_range = of_range.select("__range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in of_range.columns[1:]])
    out = at.join(F.broadcast(of_range), "__range").withColumn(place, F.col("__n_before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    if total:
        own = W.partitionBy("__range").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
        out = out.withColumn(total, F.col("__v_before") + F.coalesce(F.sum(value).over(own), F.lit(0)))
    return out.select(*df.columns, place, *([total] if total else []))


def round_robin(df: DataFrame, order: Sequence[str], parts: int, name: str = "split") -> DataFrame:
    """Row i (from 0) goes to part i mod ``parts``."""
    return numbered(df, order, name).withColumn(name, F.pmod(F.col(name), F.lit(parts)))


def chunked(df: DataFrame, order: Sequence[str], rows: int, name: str = "shard") -> DataFrame:
    """Runs of ``rows`` rows in order."""
    return numbered(df, order, name).withColumn(name, F.floor(F.col(name) / F.lit(rows)))


def evenly(df: DataFrame, order: Sequence[str], parts: int, name: str = "part") -> DataFrame:
    """Runs of rows in order, numbered from 1, whose sizes differ by one at most, the longer ones first."""
    rows = df.count()
    small, more = divmod(rows, parts)
    at = F.col(name)
    edge = more * (small + 1)
    part = F.when(at < edge, F.floor(at / F.lit(small + 1))).otherwise(more + F.floor((at - edge) / F.lit(max(small, 1))))
    return numbered(df, order, name).withColumn(name, part + 1)


def range_shards(df: DataFrame, key: str, rows_a_shard: int = 335, most: int = 9900) -> DataFrame:
    """Range-partitioned by key into max(1, min(most, rows / rows_a_shard)) partitions, for archives of like size."""
    n = df.count()
    return df.repartitionByRange(max(1, min(most, n // rows_a_shard)), key).sortWithinPartitions(key)

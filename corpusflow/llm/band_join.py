"""Numeric band join: each item with the lines whose unit price lies near its own price.

* **Totals** are differences of prefix sums.  Lines are first added up by (item, u), so that equal prices are one
  row; these rows, and the ends of all items' intervals, are sorted together by range over all tasks, each task
  gives running sums of count, u and crc at the ends that it holds and its own sums, and the sums of earlier tasks
  are added after that.  The same order holds a second key space, by item and then u: differences there are the
  lines of an item's own, which are taken off.
* **The first pairs** are found by cursors.  Of the lines at one u the first five of an item, and of these the first
  ten, are all that any item can need (five at most are its own).  They are sorted by range together with the items;
  in a task a cursor goes down and one goes up from each price, over windows that double until five pairs are
  found or the band's end is passed.  What lies in other tasks is known by the ten nearest lines on either side,
  which is again all that can be needed.

No task holds a key: rows of one price or one item are dealt by range with a hash as the last order.  The driver gets
a row of sums and twenty lines for each range, never more; a range is a partition of the sort.

Defined results: a line null in sale_id, item_id, quantity or amount, with quantity 0, or with an amount that is no
number or beyond 10^13, never pairs, nor does an item with such a price; an item null in item_id or price has no pair
(nothing is another item than an unknown one).  Lines without line_no come before others and are written empty in
the sum of crc.  Repeated lines each count; repeated items (item_id and price in cents) are one.  Empty tables give
no row, or rows without pairs; extra columns are ignored.  Sums are exact as long as they fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.llm.arrow import bounded_batches
from corpusflow.llm.scratch import Scratch

TOP = 5
LEAST_GAP = 10
PER_MILLE = 2
#: Rows of a range, on average; beyond the session's shuffle partitions.
RANGE_ROWS = 1 << 20
#: Larger amounts and prices are taken for broken.
MOST = 1e13
#: Stands for a missing line number; below all others.
NO_LINE = -(1 << 63)
#: Rows that a cursor looks at first, on either side.
WINDOW = 32
FIELDS = ("u", "sale_id", "line_no", "line_item_id")


def _cents(x: Column) -> Column:
    """floor(100 x + 0.5) as long; null for what is no number or too large."""
    x = x.cast("double")
    return F.when(F.abs(x) <= MOST, F.floor(F.lit(100.0) * F.when(F.abs(x) <= MOST, x) + F.lit(0.5)))


def _floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) of longs, b > 0."""
    return F.call_function("div", a - F.pmod(a, b), b)


def unit_prices(lines: DataFrame) -> DataFrame:
    """sale_id, line_no, line_item_id, u, crc of the lines that can pair."""
    q, a = F.col("q"), F.col("a")
    twice = F.lit(2) * F.abs(q)
    rows = lines.select(F.col("sale_id").cast("long").alias("sale_id"), F.col("line_no").cast("long").alias("line_no"), F.col("item_id").cast("long").alias("line_item_id"), F.col("quantity").cast("long").alias("q"), _cents(F.col("amount")).alias("a"))
    rows = rows.filter("sale_id is not null and line_item_id is not null and q <> 0 and a is not null")
    text = F.concat_ws(",", F.col("sale_id").cast("string"), F.coalesce(F.col("line_no").cast("string"), F.lit("")), F.col("line_item_id").cast("string"))
    u = _floor_div(F.signum(q).cast("long") * (F.lit(2) * a + q), twice)
    return rows.select("sale_id", F.coalesce("line_no", F.lit(NO_LINE)).alias("line_no"), "line_item_id", u.alias("u"), F.crc32(text.cast("binary")).alias("crc"))


def _ranges(rows: int, spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))


def prefix_sums(data: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """``asked`` (item, p, place, scope, own, v) with n, su, hi, lo: sums over all ``data`` (scope, own, v, n, su, hi, lo) up to (scope, own, v).

    Sums run over all scopes in order, so that only differences within one mean anything.  su is the sum modulo 2^64.
    """
    spark = data.sparkSession
    both = data.select("scope", "own", "v", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("p"), F.lit(-1).alias("place"), "n", "su", "hi", "lo")
    zero = F.lit(0).cast("long")
    both = both.unionByName(asked.select("scope", "own", "v", F.lit(1).alias("kind"), "item", "p", "place", zero.alias("n"), zero.alias("su"), zero.alias("hi"), zero.alias("lo")))
    order = ["scope", "own", "v", "kind"]
    both = both.withColumn("tie", F.xxhash64("item", "p", "place")).repartitionByRange(_ranges(data.count() + asked.count(), spark), *order, "tie").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), np.zeros(4, np.int64)
        names = ["item", "p", "place", "n", "su", "hi", "lo", "part"]
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            sums = np.stack([column[k].to_numpy(zero_copy_only=False) for k in ("n", "su", "hi", "lo")])
            sums = np.cumsum(sums, axis=1) + held[:, None]
            if sums.shape[1]:
                held = sums[:, -1].copy()
            is_asked = column["kind"].to_numpy(zero_copy_only=False) == 1
            kept = [column[k].filter(pa.array(is_asked)) for k in ("item", "p", "place")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x[is_asked]) for x in sums), pa.array(np.full(int(is_asked.sum()), part, np.int32))], names=names)
        none = pa.array([None], pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array([-1], pa.int32()), *(pa.array([x]) for x in held), pa.array([part], pa.int32())], names=names)

    made = scratch.table(both.mapInArrow(run, "item long, p long, place int, n long, su long, hi long, lo long, part int"))
    before, ahead = [], np.zeros(4, np.int64)
    for r in sorted(made.filter("place = -1").collect(), key=lambda r: r.part):
        before.append((r.part, *map(int, ahead)))
        with np.errstate(over="ignore"):
            ahead = ahead + np.array([r.n, r.su, r.hi, r.lo], np.int64)
    offsets = F.broadcast(spark.createDataFrame(before, "part int, n0 long, su0 long, hi0 long, lo0 long"))  # a row for each range
    wide = lambda c: F.col(c).cast("decimal(20,0)") + F.col(f"{c}0").cast("decimal(20,0)")
    return made.filter("place >= 0").join(offsets, "part").select("item", "p", "place", *(wide(c).alias(c) for c in ("n", "su", "hi", "lo")))


def _wrapped(x: Column) -> Column:
    """A decimal as the long that is equal to it modulo 2^64."""
    half, whole = F.lit(str(1 << 63)).cast("decimal(20,0)"), F.lit(str(1 << 64)).cast("decimal(21,0)")
    return (F.pmod((x + half).cast("decimal(38,0)"), whole) - half).cast("long")


def totals(by_item: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """item, p, n_pairs, gap_sum, lines_crc of ``asked`` (item, p, d) over all lines of ``by_item`` (item, u, n, hi, lo)."""
    su = F.col("u") * F.col("n")
    by_u = by_item.groupBy("u").agg(*(F.sum(c).alias(c) for c in ("n", "hi", "lo")))
    zero = F.lit(0).cast("long")
    wide = lambda df, scope, own: df.select(F.lit(scope).alias("scope"), own.alias("own"), F.col("u").alias("v"), "n", su.alias("su"), "hi", "lo")
    data = scratch.table(wide(by_u, 0, zero).unionByName(wide(by_item, 1, F.col("item"))))
    ends = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(s).alias("scope"), (zero if s == 0 else F.col("item")).alias("own"), v.alias("v")) for i, (s, v) in enumerate((s, v) for s in (0, 1) for v in (F.col("p") + F.col("d"), F.col("p"), F.col("p") - F.col("d") - 1))))
    places = asked.select("item", "p", F.explode(ends).alias("e")).select("item", "p", "e.*")
    found = prefix_sums(data, places, scratch)
    pick = lambda signs: F.element_at(F.array(*(F.lit(x).cast("decimal(2,0)") for x in signs)), F.col("place") + 1)
    count, gap = pick((1, 0, -1, -1, 0, 1)), pick((1, -2, 1, -1, 2, -1))
    crc = (F.col("hi") * F.lit(65536).cast("decimal(6,0)") + F.col("lo")).cast("decimal(36,0)")
    away = (F.col("su") - F.col("p").cast("decimal(16,0)") * F.col("n")).cast("decimal(36,0)")
    add = lambda x: _wrapped(F.sum(x.cast("decimal(38,0)")))
    return found.groupBy("item", "p").agg(add(count * F.col("n")).alias("n_pairs"), add(gap * away).alias("gap_sum"), add(count * crc).alias("lines_crc"))


def _nearest(u: np.ndarray, lines: np.ndarray, p: np.ndarray, d: np.ndarray, item: np.ndarray, top: int) -> list[np.ndarray]:
    """For each query the positions of its first ``top`` lines by (gap, position); ``lines`` are sorted by (u, ...), ``lines[:, 2]`` is the item."""
    owner, n = lines[:, 2], len(u)
    right = np.searchsorted(u, p, "left")
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(p)
    left, width = np.arange(len(p)), WINDOW
    while len(left):
        again = []
        chunk = max(1, (1 << 19) // width)
        for s in range(0, len(left), chunk):
            q = left[s : s + chunk]
            at = right[q][:, None] + np.arange(-width, width)
            inside = (at >= 0) & (at < n)
            at = np.clip(at, 0, max(n - 1, 0))
            gap = np.abs(u[at] - p[q][:, None])
            fit = inside & (gap <= d[q][:, None])
            low = right[q] - width
            cut = (low > 0) & (u[np.clip(low, 0, n - 1)] == u[np.clip(low - 1, 0, n - 1)])  # the lowest u has better lines outside
            good = fit & (owner[at] != item[q][:, None])
            good &= ~(cut[:, None] & (u[at] == u[at[:, :1]]) & (np.arange(-width, width) < 0))
            down_done = (low <= 0) | ~fit[:, 0] | (good[:, :width].sum(axis=1) >= top)
            up_done = (right[q] + width >= n) | ~fit[:, -1] | (good[:, width:].sum(axis=1) >= top)
            done = down_done & up_done
            order = np.argsort(np.where(good, gap, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :top]
            number = np.minimum(good.sum(axis=1), top)
            best = np.take_along_axis(at, order, 1)
            for k in np.flatnonzero(done):
                out[q[k]] = best[k, : number[k]]
            again.append(q[~done])
        left = np.concatenate(again)
        width *= 2
    return out


def _ends(lines: list[tuple], top: int) -> list[tuple]:
    """The first ``2 * top`` of lines in order (u, sale_id, line_no, item), of each item at most ``top``."""
    seen: dict[int, int] = {}
    kept = []
    for x in lines:
        if seen.setdefault(x[3], 0) < top:
            seen[x[3]] += 1
            kept.append(x)
            if len(kept) == 2 * top:
                break
    return kept


def _downward(u: np.ndarray, lines: np.ndarray) -> Iterator[tuple]:
    """Lines from the largest u on, each u's in their own order."""
    end = len(u)
    while end:
        start = int(np.searchsorted(u, u[end - 1], "left"))
        for i in range(start, end):
            yield (int(u[i]), *map(int, lines[i]))
        end = start


def first_pairs(lines: DataFrame, asked: DataFrame, scratch: Scratch, top: int = TOP) -> DataFrame:
    """item, p and ``found``: the first ``top`` of ``lines`` (u, sale_id, line_no, line_item_id) within d of p, of other items, by (gap, u, sale_id, line_no, line_item_id)."""
    spark = lines.sparkSession
    own = W.partitionBy("line_item_id", "u").orderBy("sale_id", "line_no")
    few = lines.select(*FIELDS).withColumn("k", F.row_number().over(own)).filter(F.col("k") <= top).drop("k")
    every = W.partitionBy("u").orderBy("sale_id", "line_no", "line_item_id")
    few = scratch.table(few.withColumn("k", F.row_number().over(every)).filter(F.col("k") <= 2 * top).drop("k"))
    none = F.lit(None).cast("long")
    both = few.select("u", "sale_id", "line_no", "line_item_id", none.alias("d")).unionByName(asked.select(F.col("p").alias("u"), none.alias("sale_id"), none.alias("line_no"), F.col("item").alias("line_item_id"), "d"))
    both = both.withColumn("tie", F.xxhash64("sale_id", "line_no", "line_item_id")).repartitionByRange(_ranges(few.count() + asked.count(), spark), "u", "tie").sortWithinPartitions(*FIELDS)
    schema = "kind int, part int, item long, p long, d long, found array<bigint>"

    def batch_of(kind: int, part: int, item, p, d, found: list) -> pa.RecordBatch:
        n = len(found)
        same = lambda x: pa.array(np.full(n, x, np.int32))
        return pa.RecordBatch.from_arrays([same(kind), same(part), pa.array(item, pa.int64()), pa.array(p, pa.int64()), pa.array(d, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["kind", "part", "item", "p", "d", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        is_line = table.column("d").is_null().combine_chunks()
        data, query = table.filter(is_line), table.filter(pa.compute.invert(is_line))
        u = data.column("u").to_numpy()
        rows = np.stack([data.column(c).to_numpy() for c in FIELDS[1:]], axis=1) if len(u) else np.zeros((0, 3), np.int64)
        p, d, item = (query.column(c).to_numpy() for c in ("u", "d", "line_item_id"))
        for s in range(0, len(p), 1 << 16):
            cut = slice(s, s + (1 << 16))
            near = _nearest(u, rows, p[cut], d[cut], item[cut], top) if len(u) else [np.zeros(0, np.int64)] * len(p[cut])
            yield batch_of(0, part, item[cut], p[cut], d[cut], [np.column_stack((u[x], rows[x])).ravel() if len(x) else x for x in near])
        if len(u) or len(p):  # a range of items alone needs its neighbours, too
            ends = _ends(((int(u[i]), *map(int, rows[i])) for i in range(len(u))), top), _ends(_downward(u, rows), top)
            for kind, lines_ in zip((1, 2), ends, strict=True):
                yield batch_of(kind, part, [None], [None], [None], [[v for line in lines_ for v in line]])

    made = scratch.table(both.mapInArrow(run, schema))
    low, high = _carried([(r.kind, r.part, r.found) for r in made.filter("kind > 0").collect()], top)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, item, p, d, found = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for k, i, at, far, flat in zip(part, item, p, d, found, strict=True):
                mine = [tuple(flat[x : x + 4]) for x in range(0, len(flat), 4)]
                worst = min(far, abs(mine[-1][0] - at)) if len(mine) >= top else far
                beyond = [x for x in (*low.get(k, ()), *high.get(k, ())) if x[3] != i and abs(x[0] - at) <= worst]
                if beyond:
                    mine = sorted(mine + beyond, key=lambda x: (abs(x[0] - at), x))[:top]
                out.append([{"gap": abs(x[0] - at), "u": x[0], "sale_id": x[1], "line_no": None if x[2] == NO_LINE else x[2], "line_item_id": x[3]} for x in mine])
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("gap", *FIELDS)]))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, kind)], names=["item", "p", "found"])

    return made.filter("kind = 0").select("part", "item", "p", "d", "found").mapInArrow(merge, "item long, p long, found array<struct<gap:bigint,u:bigint,sale_id:bigint,line_no:bigint,line_item_id:bigint>>")


def _carried(summaries: list[tuple[int, int, list[int]]], top: int) -> tuple[dict, dict]:
    """For each range the nearest lines below and above it, from the two summaries of each range (1: its first lines, 2: its last ones)."""
    heads, tails = ({part: [tuple(flat[x : x + 4]) for x in range(0, len(flat), 4)] for kind, part, flat in summaries if kind == k} for k in (1, 2))
    low, high, parts = {}, {}, sorted(heads)
    held: list[tuple] = []
    for part in parts:
        low[part] = held
        held = _ends(sorted(held + tails[part], key=lambda x: (-x[0], x)), top)
    held = []
    for part in reversed(parts):
        high[part] = held
        held = _ends(sorted(held + heads[part]), top)
    return low, high


def band_join(lines: DataFrame, items: DataFrame, top: int = TOP, least_gap: int = LEAST_GAP, per_mille: int = PER_MILLE) -> DataFrame:
    """Each item's first ``top`` pairs and totals; gaps of at most ``least_gap`` cents, or ``per_mille`` thousandths of the price."""
    spark = lines.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    priced = items.select(F.col("item_id").cast("long").alias("item"), _cents(F.col("price")).alias("p")).distinct()
    wide = _floor_div(F.lit(per_mille) * F.col("p"), F.lit(1000).cast("long"))
    asked = scratch.table(priced.filter("item is not null and p is not null").withColumn("d", F.greatest(F.lit(least_gap).cast("long"), wide)))
    sold = unit_prices(lines)
    by_item = sold.groupBy(F.col("line_item_id").alias("item"), "u").agg(F.count("*").alias("n"), F.sum(F.shiftright("crc", 16)).alias("hi"), F.sum(F.col("crc").bitwiseAND(F.lit(65535))).alias("lo"))
    summed = totals(scratch.table(by_item), asked, scratch)
    pairs = first_pairs(sold, asked, scratch, top)
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    apart = priced.filter("item is null or p is null").select("item", "p", *(zero.alias(c) for c in ("n_pairs", "gap_sum", "lines_crc")), F.array().cast("array<struct<gap:bigint,u:bigint,sale_id:bigint,line_no:bigint,line_item_id:bigint>>").alias("found"))
    whole = summed.join(pairs, ["item", "p"]).select("item", "p", "n_pairs", "gap_sum", "lines_crc", "found").unionByName(apart)
    at = whole.select("item", "p", "n_pairs", "gap_sum", "lines_crc", F.posexplode_outer("found").alias("k", "x"))
    fields = [F.coalesce(F.col(f"x.{c}"), none).alias(c) for c in ("gap", *FIELDS)]
    return at.select(F.col("item").alias("item_id"), F.coalesce(F.col("k") + 1, F.lit(0)).cast("int").alias("rank"), *fields, "n_pairs", "gap_sum", "lines_crc", F.col("p").alias("price_cents"))


def op13_band_join(spark, sf_dir: str) -> DataFrame:
    """All sale lines and all items."""
    return band_join(spark.read.parquet(f"{sf_dir}/sale_lines.parquet"), spark.read.parquet(f"{sf_dir}/items.parquet"))


#: The crc32 is worked out from its polynomial, 3988292384.
ORACLE = """
WITH t AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab FROM range(256) AS r(i)),
a AS (SELECT sale_id, line_no, item_id AS line_item_id, CAST(quantity AS BIGINT) AS q, CAST(floor(100 * amount + 0.5) AS BIGINT) AS a FROM sale_lines
  WHERE sale_id IS NOT NULL AND item_id IS NOT NULL AND quantity <> 0 AND abs(amount) <= 1e13),
b AS (SELECT sale_id, CAST(line_no AS BIGINT) AS line_no, line_item_id, sign(q) * (2 * a + q) AS x, 2 * abs(q) AS y, concat_ws(',', sale_id, coalesce(CAST(line_no AS VARCHAR), ''), line_item_id) AS s FROM a),
l AS (SELECT sale_id, line_no, line_item_id, (x - ((x % y) + y) % y) // y AS u,
  xor(list_reduce(list_transform(string_split(s, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]), 4294967295), 4294967295) AS crc FROM b, t),
i AS (SELECT DISTINCT item_id, CASE WHEN abs(price) <= 1e13 THEN CAST(floor(100 * price + 0.5) AS BIGINT) END AS p FROM items),
d AS (SELECT item_id, p, greatest(10, floor(2 * p / 1000.0)::BIGINT) AS d FROM i),
m AS (SELECT d.item_id, p, abs(u - p) AS gap, u, sale_id, line_no, line_item_id, crc FROM d JOIN l ON u BETWEEN p - d AND p + d AND line_item_id <> d.item_id),
n AS (SELECT item_id, p, count(*) AS n_pairs, sum(gap) AS gap_sum, sum(crc) AS lines_crc FROM m GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, p ORDER BY gap, u, sale_id, line_no NULLS FIRST, line_item_id) AS rank FROM m)
SELECT i.item_id, CAST(coalesce(r.rank, 0) AS INTEGER) AS rank, gap, u, sale_id, line_no, line_item_id, CAST(coalesce(n_pairs, 0) AS BIGINT) AS n_pairs, CAST(coalesce(gap_sum, 0) AS BIGINT) AS gap_sum,
  CAST(coalesce(lines_crc, 0) AS BIGINT) AS lines_crc, i.p AS price_cents
FROM i LEFT JOIN n ON n.item_id = i.item_id AND n.p = i.p LEFT JOIN r ON r.item_id = i.item_id AND r.p = i.p AND r.rank <= 5"""

"""Array expressions whose work grows with the array's length, not with its square.

A fold that appends to an array or a text copies it at every step.  Here running sums, maxima and minima
are found by doubling: after step k each element holds the result over the 2^k elements that end at it.
Pieces of a text are cut from blocks, so that none is looked for from the text's beginning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Arrays of up to 2^28 elements; no text that Spark can hold (2 GB) has as many spans of eight characters.
DOUBLINGS = 28
#: Code points of the blocks that a text is cut into.
BLOCK = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``op``, which must be associative and commutative."""
    widths = F.transform(F.sequence(F.lit(0), F.lit(DOUBLINGS - 1)), lambda k: F.call_function("shiftleft", F.lit(1), k))
    once = lambda a, w: F.transform(a, lambda x, i: F.when(i >= w, op(x, F.get(a, i - w))).otherwise(x))
    return F.reduce(widths, values, lambda a, w: F.when(F.size(a) > w, once(a, w)).otherwise(a))


def blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def piece(cut: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of the text that was cut into blocks."""
    first = F.floor(start / BLOCK).cast("int")
    held = F.array_join(F.slice(cut, first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * BLOCK + 1, end - start)).otherwise(F.lit(""))


def replaced(text: Column, spans: Column, by: Callable[[Column], Column]) -> Column:
    """``text`` with ``by`` (length) in place of each stretch that sorted ``spans`` (start, end) cover; spans that overlap or touch are one."""

    def with_ends(ends: Column) -> Column:
        # the end of what lies before each span; a stretch ends where the next span starts beyond all ends so far
        heads = F.filter(F.transform(spans, lambda x, i: F.struct(x["start"].alias("at"), F.coalesce(F.get(ends, i - 1), F.lit(-1)).alias("before"))), lambda x: x["at"] > x["before"])
        stops = F.concat(F.slice(F.transform(heads, lambda x: x["before"]), F.lit(2), F.greatest(F.size(heads) - 1, F.lit(0))), F.array(F.element_at(ends, -1)))
        whole = F.arrays_zip(F.transform(heads, lambda x: x["at"]).alias("a"), stops.alias("b"), F.transform(heads, lambda x: F.greatest(x["before"], F.lit(0))).alias("gap"))
        return let(whole, lambda z: let(blocks(text), lambda cut: F.concat(F.array_join(F.transform(z, lambda s: F.concat(piece(cut, s["gap"], s["a"]), by(s["b"] - s["a"]))), ""), piece(cut, F.element_at(z, -1)["b"], F.length(text)))))

    made = let(running(F.transform(spans, lambda x: x["end"]), F.greatest), with_ends)
    return F.when(F.size(spans) > 0, made).otherwise(text)

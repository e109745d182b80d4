"""Positions of regular-expression matches with SQL functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


#: Matches whose starts are summed up at a time.
BLOCK = 256


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value taken once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(parts: Column, step: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), step)


def _starts(matches: Column) -> Column:
    """Running starts of matches (gap before each, length). An array grows by
    copying, so the sums are taken in blocks, and the blocks' offsets are added after."""
    def inside(s: Column, m: Column) -> Column:
        return F.struct((s["at"] + m["g"] + m["n"]).alias("at"), F.array_append(s["all"], s["at"] + m["g"]).alias("all"))

    def over(blocks: Column) -> Column:
        offsets = _running(blocks, lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.array_append(s["all"], s["at"]).alias("all")))["all"]
        return F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b["all"], lambda x: x + o)))

    def cut(m: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int"))
        return F.when(F.size(m) > 0, F.transform(places, lambda k: _running(F.slice(m, k * BLOCK + 1, F.lit(BLOCK)), inside)))
    return F.coalesce(_with(_with(matches, cut), over), F.array().cast("array<int>"))


def match_spans(text: Column, pattern: str, needs: str | None = None) -> Column:
    """array<struct<start,end,value>> of the leftmost non-overlapping matches,
    in code points, end exclusive; the empty array for none. Linear in the text,
    but for copies of ``BLOCK`` starts a match. Splitting by a
    pattern and extracting by it see the same matches, so the lengths of the
    pieces between the matches give the positions. ``needs`` is a text without
    which there can be no match; it saves the search."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))

    def placed(values: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, 1, F.size(values)), F.transform(values, lambda v: F.length(v)), lambda g, n: F.struct(g.alias("g"), n.alias("n")))
        return F.zip_with(_starts(sizes), values, lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value")))
    spans = _with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return spans if needs is None else F.when(F.contains(text, F.lit(needs)), spans).otherwise(none)

"""Array-expression helpers: everything stays in one row, so nothing shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(array: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Indexes, from 0, of the elements for which test(element, index) holds."""
    index = F.transform(array, lambda x, i: F.when(test(x, i), i))
    return F.filter(index, lambda i: i.isNotNull())


def islands(array: Column, starts: Column) -> Column:
    """Slices of array that begin at the indexes `starts`; what precedes the first is left out."""

    def cut(a: Column) -> Column:
        return bound(starts, lambda s: F.transform(s, lambda at, k: F.slice(a, at + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - at)))

    return bound(array, cut)


def carried(array: Column, value: Callable[[Column], Column], initial: int) -> Column:
    """For each element the last non-null integer value(element) up to it, `initial` before any."""

    def laid(a: Column) -> Column:
        marks = F.filter(F.transform(a, lambda x, i: F.struct(value(x).cast("int").alias("v"), i.alias("i"))), lambda m: m["v"].isNotNull())
        return bound(marks, lambda m: F.concat(F.array_repeat(F.lit(initial).cast("int"), F.coalesce(F.get(m, F.lit(0))["i"], F.size(a))), F.flatten(F.transform(m, lambda x, k: F.array_repeat(x["v"], F.coalesce(F.get(m, k + 1)["i"], F.size(a)) - x["i"])))))

    return bound(array, laid)


#: Elements that running() sums at a time.
BLOCK = 64


def running(values: Column) -> Column:
    """Sum of the integers up to and with each one.

    Blocks are summed by themselves and their totals carried over, so that no array of
    all sums is copied for each element.
    """
    total = lambda v: F.aggregate(v, F.lit(0), lambda s, x: s + x)

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        return F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(bound(blocks, summed))

    def summed(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda s, b: F.concat(s, F.array(F.element_at(s, -1) + total(b))))
        return bound(before, lambda o: F.flatten(F.transform(blocks, lambda b, k: F.transform(b, lambda _, i: F.get(o, k) + total(F.slice(b, 1, i + 1))))))

    return bound(values, whole)


def matches(text: Column, pattern: str, group: int = 0, within: bool = False) -> Column:
    """array of (start, end, found, value) of all matches, in code points; `value` is a group.

    Ends are running sums of the lengths of gaps and matches; matches must not be empty. With
    `within` the group is read from the match itself, not in a further pass over the text; the
    pattern must then not depend on what follows.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    parts = F.struct(whole, *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")] if group and not within else []), F.split(text, pattern, -1).alias("gap"))

    def placed(p: Column) -> Column:
        values = p["found"] if not group else F.transform(p["found"], lambda f: F.regexp_extract(f, pattern, group)) if within else p["value"]
        ends = running(F.transform(p["found"], lambda f, i: F.length(F.get(p["gap"], i)) + F.length(f)))
        return F.transform(ends, lambda e, i: F.struct((e - F.length(F.get(p["found"], i))).alias("start"), e.alias("end"), F.get(p["found"], i).alias("found"), F.get(values, i).alias("value")))

    return bound(parts, placed)

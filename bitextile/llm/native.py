"""Column helpers for operators that use built-in functions alone.

Long texts can hold very many matches, so nothing here copies an array or reads the text from its start once for each
match: running sums, cuts and counts go by blocks of about the square root of their number, or by binary search.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def block_size(n: Column) -> Column:
    return F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(n)).cast("int"))


def sums_before(values: Column) -> Column:
    """For each of an array of integers the sum of those before it."""

    def within(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def of(v: Column, step: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), step), lambda b: within(F.slice(v, b + 1, step)))
        return let(blocks, lambda bs: let(within(F.transform(bs, lambda b: b["at"])), lambda total: F.flatten(F.zip_with(bs, total["out"], lambda b, t: F.transform(b["out"], lambda x: x + t)))))

    return let(values, lambda v: F.when(F.size(v) > 0, let(block_size(F.size(v)), lambda step: of(v, step))).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of (start, end, value) of all non-overlapping matches, in code points, end exclusive.

    Matches and the pieces between them alternate, so places are running sums of their lengths. `value` is the given
    group, by default the whole match. The pattern must not match the empty text.
    """
    p = F.lit(pattern)

    def placed(found: Column) -> Column:
        sizes = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda a, b: F.length(a) + F.length(b))
        values = found if group is None else F.regexp_extract_all(text, p, F.lit(group))
        ends = F.zip_with(sums_before(sizes), sizes, lambda a, b: a + b)
        return F.zip_with(F.zip_with(ends, found, lambda e, b: F.struct((e - F.length(b)).alias("start"), e.alias("end"))), values, lambda x, v: F.struct(x["start"].alias("start"), x["end"].alias("end"), v.alias("value")))

    return let(F.regexp_extract_all(text, p, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>")))


def below(ordered: Column, x: Column) -> Column:
    """How many elements of a sorted array are less than x, by binary search."""
    powers = F.reverse(F.sequence(F.lit(0), F.ceil(F.log2(F.size(ordered) + 1)).cast("int")))

    def step(acc: Column, k: Column) -> Column:
        to = acc + F.pow(F.lit(2), k).cast("int")
        return F.when((to <= F.size(ordered)) & (F.get(ordered, to - 1) < x), to).otherwise(acc)

    return F.when(F.size(ordered) == 0, F.lit(0)).otherwise(F.aggregate(powers, F.lit(0), step))


def touches(spans: Column, other: Column) -> Column:
    """For each span (start, end), whether any of the other spans overlaps it: those that begin before its end are more
    than those that end at its start or before."""

    def of(starts: Column, ends: Column) -> Column:
        return F.transform(spans, lambda x: below(starts, x["end"]) > below(ends, x["start"] + 1))

    return let(F.sort_array(F.transform(other, lambda y: y["start"])), lambda s: let(F.sort_array(F.transform(other, lambda y: y["end"])), lambda e: of(s, e)))


def merged(spans: Column) -> Column:
    """The union of spans (start, end) as starts and ends of disjoint ranges, in order; ranges that only touch stay apart.

    Of starts and ends, each sorted, the i-th start opens a range if the end before it in rank is not after it.
    """

    def of(s: Column, e: Column) -> Column:
        starts = F.filter(s, lambda x, i: (i == 0) | (F.get(e, i - 1) <= x))
        ends = F.filter(e, lambda x, i: (i == F.size(e) - 1) | (x <= F.get(s, i + 1)))
        return F.struct(starts.alias("starts"), ends.alias("ends"))

    return let(F.sort_array(F.transform(spans, lambda y: y["start"])), lambda s: let(F.sort_array(F.transform(spans, lambda y: y["end"])), lambda e: of(s, e)))


def outside(text: Column, starts: Column, ends: Column) -> Column:
    """The pieces of a text before, between and after disjoint ranges, one more than there are ranges."""
    k = F.size(starts)
    start_of = lambda j: F.coalesce(F.get(starts, j), F.length(text))
    end_before = lambda j: F.when(j == 0, 0).otherwise(F.get(ends, j - 1))

    def block(first: Column, step: Column) -> Column:
        last = F.least(first + step - 1, k)
        part = let(end_before(first), lambda at: let(F.substring(text, at + 1, start_of(last) - at), lambda seg: F.transform(F.sequence(first, last), lambda j: F.substring(seg, end_before(j) - at + 1, start_of(j) - end_before(j)))))
        return part

    return let(block_size(k), lambda step: F.flatten(F.transform(F.sequence(F.lit(0), k, step), lambda first: block(first, step))))

"""Column builders over arrays and regex matches; built-in functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, as a regex class and as the characters to trim.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def no_nulls(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The runs of other characters than ASCII white space."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE, -1))


def indices(n: Column) -> Column:
    """0 .. n - 1; none for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


#: An aggregate that appends to an array copies it each time, so arrays are scanned in chunks of so many.
CHUNK = 64


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What ``merge``, which is associative, makes of each element and all before it."""

    def scanned(part: Column) -> Column:
        add = lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x)))
        return F.aggregate(F.slice(part, 2, F.size(part)), F.slice(part, 1, 1), add)

    def joined(parts: Column) -> Column:
        ends = scanned(F.transform(parts, lambda part: F.element_at(part, -1)))
        later = lambda e: F.transform(parts, lambda part, c: F.when(c == 0, part).otherwise(F.transform(part, lambda x: merge(F.get(e, c - 1), x))))
        return F.flatten(let(ends, later))

    def chunks(v: Column) -> Column:
        return F.transform(indices(F.ceil(F.size(v) / CHUNK).cast("int")), lambda c: scanned(F.slice(v, c * CHUNK + 1, CHUNK)))

    return let(values, lambda v: let(chunks(v), joined))


def matches(text: Column, regex: str | Column) -> Column:
    """Array of (first, end, found): matches from left to right, in code points, end exclusive.

    Spark tells what matches but not where; the pieces between matches give the places.
    """
    pattern = F.lit(regex) if isinstance(regex, str) else regex

    def placed(between: Column, found: Column) -> Column:
        steps = F.transform(found, lambda f, i: F.length(F.get(between, i)) + F.length(f))
        span = lambda end, f: F.struct((end - F.length(f)).alias("first"), end.alias("end"), f.alias("found"))
        return let(running(steps, lambda a, b: a + b), lambda ends: F.transform(found, lambda f, i: span(F.get(ends, i), f)))

    return let(
        F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found")),
        lambda s: placed(s["between"], s["found"]),
    )

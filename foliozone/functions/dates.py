"""Dates, half-open periods and their labels, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliozone.functions.text import strip

SIZES = ("daily", "weekly", "monthly")

_DAY = r"(3[01]|[12]\d|0[1-9]| ?[1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_YEAR = r"((?!0000)\d{4})"

# The accepted shapes. The day-first two are turned round, in this order.
_SLASHED = rf"^{_DAY}/{_MONTH}/{_YEAR}\z"
_DASHED = rf"^{_DAY}-{_MONTH}-{_YEAR}\z"
_ISO = rf"^{_YEAR}-{_MONTH}-{_DAY}\z"


def check_size(size: str) -> str:
    if size not in SIZES:
        raise ValueError(f"periods are {', '.join(SIZES)}, not {size!r}")
    return size


def parse_date(raw: Column) -> Column:
    """``31/01/2024``, ``2024-01-31`` or ``31-01-2024`` as a date; anything else is null.

    Written with ``try_cast`` because ANSI mode turns a bad ``to_date`` into a failed job.
    """
    text = strip(raw)
    for shape in (_SLASHED, _DASHED):
        text = F.regexp_replace(text, shape, "$3-$2-$1")
    iso = F.regexp_extract(text, _ISO, 0)
    return F.replace(iso, F.lit(" "), F.lit("")).try_cast("date")


def format_site_date(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def utc_midnight(d: Column) -> Column:
    """The stored timestamp form of a date; the session runs in UTC."""
    return d.cast("timestamp")


def from_utc_midnight(ts: Column) -> Column:
    return ts.cast("date")


def next_boundary(d: Column, size: str) -> Column:
    check_size(size)
    if size == "monthly":
        return F.add_months(F.trunc(d, "MM"), 1)
    return F.date_add(d, 7 if size == "weekly" else 1)


def period_label(start: Column, size: str) -> Column:
    """``2024-01``, ISO ``2024-W05`` or ``2024-01-31``, from the window's first day."""
    check_size(size)
    if size == "monthly":
        return F.date_format(start, "yyyy-MM")
    if size == "weekly":
        year = F.extract(F.lit("YEAROFWEEK"), start).cast("string")
        return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(start).cast("string"), 2, "0"))
    return F.date_format(start, "yyyy-MM-dd")


def last_included_day(end: Column) -> Column:
    return F.date_sub(end, 1)


def contains(d: Column, start: Column, end: Column) -> Column:
    return (d >= start) & (d < end)


def window_of(d: Column, start: Column, end: Column, size: str) -> Column:
    """The planned window of ``[start, end)`` that holds ``d``, or null outside the range.

    Arithmetic instead of a range join: no shuffle, no broadcast, any number of windows.
    """
    check_size(size)
    if size == "monthly":
        first = F.greatest(F.trunc(d, "MM"), start)
        after = next_boundary(d, size)
    else:
        step = 7 if size == "weekly" else 1
        first = F.date_add(start, (F.floor(F.datediff(d, start) / step) * step).cast("int"))
        after = F.date_add(first, step)
    return F.when(
        contains(d, start, end),
        F.struct(
            first.alias("start"),
            F.least(after, end).alias("end"),
            period_label(first, size).alias("label"),
        ),
    )


def windows(start: Column, end: Column, size: str) -> Column:
    """All windows of ``[start, end)`` in order, as an array to ``posexplode``."""
    check_size(size)
    last = F.date_sub(end, 1)
    if size == "monthly":
        firsts = F.sequence(F.trunc(start, "MM"), last, F.expr("interval 1 month"))
    else:
        step = F.expr("interval 7 day" if size == "weekly" else "interval 1 day")
        firsts = F.sequence(start, last, step)

    def window(first: Column) -> Column:
        opened = F.greatest(first, start)
        return F.struct(
            opened.alias("start"),
            F.least(next_boundary(first, size), end).alias("end"),
            period_label(opened, size).alias("label"),
        )

    return F.transform(firsts, window)

"""Windows, cells and everything addressed by them."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone.functions import dates
from foliozone.sources.adapter import Body, SourceAdapter

# Fixed value: the first day of the backfill grid.
GRID_START = date(2015, 1, 1)

# Day first with slashes or hyphens, or year first with hyphens.
_ARGUMENT = re.compile(r"(?P<d>\d{1,2})(?P<by>[/-])(?P<m>\d{1,2})(?P=by)(?P<y>\d{4})|(?P<y2>\d{4})-(?P<m2>\d{1,2})-(?P<d2>\d{1,2})")


def as_date(value: date | str) -> date:
    """A date argument, given as a date or as text."""
    if isinstance(value, date):
        return value
    found = _ARGUMENT.fullmatch(value.strip())
    if found is None:
        raise ValueError(f"{value!r} is no date such as 2024-12-31, 31/12/2024 or 31-12-2024")
    year, month, day = (int(found[part] or found[part + "2"]) for part in "ymd")
    return date(year, month, day)


def check_range(start: date, end: date) -> None:
    if end <= start:
        raise ValueError(f"no day lies in the half-open range {start} .. {end}")


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def plan_windows(spark: SparkSession, start: date, end: date, size: str) -> DataFrame:
    """The half-open windows of a range, in order; the last one is clipped to ``end``."""
    check_range(start, end)
    return windows_of(_one_row(spark), F.lit(start), F.lit(end), size)


def windows_of(bounds: DataFrame, start: Column, end: Column, size: str) -> DataFrame:
    """Windows for a one-row table of bounds, so a range can also come out of the data."""
    return bounds.select(F.posexplode(dates.windows(start, end, size)).alias("window_seq", "w")).select(
        F.col("window_seq").cast("bigint").alias("window_seq"), "w.start", "w.end", "w.label"
    )


def window_starting_at(start: date, size: str) -> tuple[date, date]:
    """The unclipped window that begins on a day."""
    dates.check_size(size)
    if size == "monthly":
        following = (start.replace(day=1) + timedelta(days=32)).replace(day=1)
        return start, following
    return start, start + timedelta(days=7 if size == "weekly" else 1)


def _body_array(bodies: tuple[Body, ...]) -> Column:
    return F.array(
        *(
            F.struct(F.lit(b.code).alias("code"), F.lit(b.name).alias("name"), F.lit(b.external_id).alias("external_id"))
            for b in bodies
        )
    )


def cells_of(bounds: DataFrame, start: Column, end: Column, size: str, bodies: Column) -> DataFrame:
    """Window-major grid of windows x bodies; a repeated body gives repeated cells.

    Both sides are arrays of one row, exploded in turn: no join, and the ordinal is arithmetic.
    """
    return (
        bounds.select(dates.windows(start, end, size).alias("ws"), bodies.alias("bs"))
        .select(F.posexplode("ws").alias("wi", "w"), "bs")
        .select("wi", "w", F.size("bs").alias("n"), F.posexplode("bs").alias("bi", "b"))
        .select(
            (F.col("wi").cast("bigint") * F.col("n") + F.col("bi")).alias("cell_seq"),
            "w.start",
            "w.end",
            "w.label",
            F.col("b.code").alias("body_code"),
            F.col("b.name").alias("body_name"),
            F.col("b.external_id").alias("external_id"),
        )
    )


def plan_cells(
    spark: SparkSession,
    adapter: SourceAdapter,
    start: date,
    end: date,
    size: str = "monthly",
    body_codes: tuple[str, ...] | None = None,
) -> DataFrame:
    check_range(start, end)
    bodies = adapter.select_bodies(body_codes)
    return cells_of(_one_row(spark), F.lit(start), F.lit(end), size, _body_array(bodies))


def backfill_cells(spark: SparkSession, adapter: SourceAdapter, until: date, size: str = "monthly") -> DataFrame:
    """The orchestrated grid: every complete window since the fixed origin, for every body.

    Weekly windows of this grid open on Sundays, unlike those of a range, which open on its
    first day.
    """
    dates.check_size(size)
    start = GRID_START
    if size == "weekly":
        start += timedelta(days=(6 - start.weekday()) % 7)
    return plan_cells(spark, adapter, start, until, size).filter(
        dates.next_boundary(F.col("start"), size) <= F.lit(until)
    )


def join_cells(df: DataFrame, cells: DataFrame, on: str | list[str] = "cell_seq") -> DataFrame:
    """Attach cell columns. No hint: the planner broadcasts the grid by its size, or does not."""
    return df.join(cells, on)


def placed(df: DataFrame, cells: DataFrame, start: date, end: date, size: str) -> DataFrame:
    """Rows with the cell that their ``decision_date`` and ``body_code`` fall into.

    The window is computed from the date, so the join is an equality, never a range.
    """
    window = dates.window_of(F.col("decision_date"), F.lit(start), F.lit(end), size)
    keyed = df.withColumn("start", window["start"]).filter(F.col("start").isNotNull())
    return join_cells(keyed, cells.select("cell_seq", "start", "label", "body_code"), ["start", "body_code"]).drop("start")


def coverage(cells: DataFrame, records: DataFrame) -> DataFrame:
    """Records held per cell of a grid, by ingest label and body; empty cells show zero."""
    held = records.groupBy(F.col("partition_date").alias("label"), "body_code").agg(F.count("*").alias("records"))
    return cells.join(held, ["label", "body_code"], "left").withColumn(
        "records", F.coalesce("records", F.lit(0).cast("bigint"))
    )


def missing_cells(cells: DataFrame, records: DataFrame) -> DataFrame:
    held = records.select(F.col("partition_date").alias("label"), "body_code").distinct()
    return cells.join(held, ["label", "body_code"], "left_anti")


def request_frontier(cells: DataFrame, adapter: SourceAdapter, pages: Column) -> DataFrame:
    """One listing request per cell and page number, for a fetcher outside Spark."""
    return cells.select("*", F.explode(F.sequence(F.lit(1), pages)).alias("page_number")).withColumn(
        "url",
        adapter.listing_url(F.col("start"), F.col("end"), F.col("external_id"), F.col("page_number")),
    )

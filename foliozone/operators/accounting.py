"""Counts that must add up: per cell, per run, per error code."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.operators.changes import UNCHANGED, WRITTEN

# Fixed value: the code of a cell that could not be collected at all.
DEAD_CELL = "PartitionIngestionError"


def cell_summary(
    cells: DataFrame,
    outcomes: DataFrame,
    collection_failures: DataFrame,
    totals: DataFrame | None,
    stage: str,
) -> DataFrame:
    """One row per planned cell, including the ones that hold nothing.

    Rows and failures of no planned cell get a row without partition, which is never complete, so
    that nothing that was captured leaves the count. (A total alone, of a cell that another run
    plans, is nobody's row.) ``outcomes`` needs ``cell_seq, action``; ``totals`` is the site's own count and, where it is
    absent, found means collected, which reconciles trivially unless a collection failed.
    """
    none = F.lit(None).cast("bigint")

    def contribution(df: DataFrame, **values: Column) -> DataFrame:
        columns = {"action": F.lit(None).cast("string"), "collected": F.lit(0), "unread": F.lit(0), "total": none, **values}
        return df.select("cell_seq", *(c.alias(n) for n, c in columns.items()))

    parts = [
        contribution(outcomes, action=F.col("action"), collected=F.lit(1)),
        contribution(collection_failures, unread=F.lit(1)),
    ]
    if totals is not None:
        parts.append(contribution(totals, total=F.col("reported_total")))
    # one aggregation with map-side combine, whatever feeds a cell
    counted = reduce(lambda a, b: a.unionByName(b), parts).groupBy("cell_seq").agg(
        F.sum("collected").alias("collected"),
        F.count_if(F.col("action") == WRITTEN).alias("records_written"),
        F.count_if(F.col("action") == UNCHANGED).alias("records_unchanged"),
        F.sum("unread").alias("unread"),
        F.max("total").alias("reported_total"),
    )
    planned = cells.withColumn("planned", F.lit(True))
    joined = planned.join(counted, "cell_seq", "full").filter("planned OR collected > 0 OR unread > 0")

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    failed = or_zero("collected") - or_zero("records_written") - or_zero("records_unchanged") + or_zero("unread")
    return joined.select(
        F.lit(stage).alias("stage"),
        "cell_seq",
        F.col("label").alias("partition"),
        F.col("body_code").alias("body"),
        F.coalesce(F.col("reported_total").cast("bigint"), or_zero("collected")).alias("records_found"),
        or_zero("records_written").alias("records_written"),
        or_zero("records_unchanged").alias("records_unchanged"),
        failed.alias("records_failed"),
        (F.col("planned").isNotNull() & (or_zero("unread") == 0)).alias("collection_complete"),
    ).withColumn("accounted_for", accounted_for())


def accounted_for() -> Column:
    handled = F.col("records_written") + F.col("records_unchanged") + F.col("records_failed")
    return F.col("collection_complete") & (F.col("records_found") == handled)


def run_summary(summary: DataFrame, stage: str, source: str, start: date, end: date) -> DataFrame:
    """One row: sums over cells, and flags that hold only if they hold in every cell."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)

    def every(name: str) -> Column:
        return F.coalesce(F.bool_and(name), F.lit(True)).alias(name)

    return summary.agg(
        F.count("partition").alias("partitions"),
        *(total(n) for n in ("records_found", "records_written", "records_unchanged", "records_failed")),
        every("collection_complete"),
        every("accounted_for"),
    ).select(
        F.lit(stage).alias("stage"),
        F.lit(source).alias("source"),
        F.lit(start.isoformat()).alias("start_date"),
        F.lit(end.isoformat()).alias("end_date"),
        "*",
    )


def run_verdict(run_summaries: list[DataFrame]) -> DataFrame:
    """One row: did every stage account for every cell?"""
    rows = reduce(lambda a, b: a.unionByName(b), run_summaries)
    return rows.agg(F.coalesce(F.bool_and("accounted_for"), F.lit(True)).alias("succeeded"))


def failure_rows(cells: DataFrame, stage: str, failed: DataFrame, collection_failures: DataFrame) -> DataFrame:
    """Every failure, of records and of collections, with its cell. No row is left unnamed."""
    records = failed.select(
        "cell_seq", "identifier", "url", "error_code", F.col("error_reason").alias("reason"), F.lit(False).alias("is_collection")
    )
    named = cells.select("cell_seq", F.col("label").alias("partition"), F.col("body_code").alias("body"))
    return (
        records.unionByName(collection_failures)
        .join(named, "cell_seq", "left")
        .select(
            F.lit(stage).alias("stage"),
            "cell_seq",
            "partition",
            "body",
            "identifier",
            "url",
            "error_code",
            "reason",
            "is_collection",
        )
    )


def failure_breakdown(failures: DataFrame) -> DataFrame:
    return failures.groupBy("stage", "error_code").agg(F.count("*").alias("failures"))


def dead_cells_as_failures(dead: DataFrame) -> DataFrame:
    return dead.select(
        "cell_seq",
        F.lit(None).cast("string").alias("identifier"),
        F.lit(None).cast("string").alias("url"),
        F.lit(DEAD_CELL).alias("error_code"),
        "reason",
        F.lit(True).alias("is_collection"),
    )


def failure_lines(failures: DataFrame) -> DataFrame:
    """Failures in their one-line form, under the names that such lines carry."""
    return as_lines(failures.withColumnsRenamed({"identifier": "failed_identifier", "url": "failed_url"}))


def as_lines(summary: DataFrame) -> DataFrame:
    """The one-line JSON form of summaries and failures."""
    return summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))

"""Repeated references inside a cell, and the order in which a row can fail."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.functions.text import blank_to_null, quoted
from foliozone.operators.changes import seen_twice
from foliozone.session import stage

# Error codes and messages of failed rows.
DUPLICATE = "duplicate_case_reference"
REPEATED = (
    "case reference ",
    " is already used in this partition by ",
    "; this row is a different document at ",
)
DUPLICATE_REASON = "case reference already seen in this partition"
DOWNLOAD_ERROR = "DocumentDownloadError"
DOWNLOAD_REASON = "document could not be downloaded"
LISTING_ERROR = "listing_page_unreadable"
LISTING_REASON = "listing page could not be read"
# Fixed value: a reason is cut here, as the captured system does.
REASON_LIMIT = 500

UNPLACED = "row_of_no_planned_cell"
UNPLACED_REASON = "the row's cell, label or body is not one of this run"

REFERENCE = ["cell_seq", "body_code", "identifier"]


def mark_repeats(items: DataFrame) -> DataFrame:
    """Add ``first_url``: null for the first row of a reference in its cell, else that row's url.

    Rows are ordered by their number, then their url, then ``row_id`` where they carry one, so that
    equal numbers do not make two first rows; null references are one reference like any other.
    Keys are counted with map-side combine over their hashes only, and just the keys seen twice or
    more are staged and go back to the rows. Those are few on real listings, so the planner
    broadcasts them by file size and the rows do not move. If there are many, or one reference
    holds a large share of all rows, their side is still one row per key and the rows' side can
    be split. ``items`` is read four times: pass narrow rows.
    """
    order = F.struct(*(c for c in ("item_seq", "document_url", "row_id") if c in items.columns))
    owners = items.filter(F.coalesce(F.col("error_code") != UNPLACED, F.lit(True)))
    repeated = stage(
        seen_twice(owners, REFERENCE)
        .groupBy(*REFERENCE)
        .agg(
            F.count("*").alias("n"),
            F.min(order).alias("first_place"),
            F.min_by("document_url", order).alias("kept_url"),
        )
        .filter("n > 1")
        .drop("n"),
        "repeated_references",
    )
    repeated = repeated.withColumnsRenamed({c: f"first_{c}" for c in REFERENCE})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in REFERENCE))
    later = F.col("first_place").isNotNull() & (order > F.col("first_place"))
    first_url = F.when(later, F.coalesce("kept_url", F.lit("")))
    return items.join(repeated, same, "left").withColumn("first_url", first_url).drop(*repeated.columns)


def repeat_reason(identifier: Column, first_url: Column, url: Column) -> Column:
    named, kept, this = (F.lit(part) for part in REPEATED)
    return F.concat(named, F.coalesce(quoted(identifier), F.lit("None")), kept, first_url, this, F.coalesce(url, F.lit("")))


def with_failures(items: DataFrame) -> DataFrame:
    """Settle ``error_code`` and ``error_reason``: null means the row goes on to storage.

    A repeat is rejected before its own download is looked at, and a first row that failed to
    download still owns its reference. Needs ``first_url`` and ``has_payload``.
    """
    unplaced = F.col("error_code") == UNPLACED if "row_id" in items.columns else F.lit(False)
    code, reason = blank_to_null(F.col("error_code")), blank_to_null(F.col("error_reason"))
    repeat = F.col("first_url").isNotNull()
    told = F.coalesce(F.col("error_code") == DUPLICATE, F.lit(False))
    missing = ~F.col("has_payload")
    return items.withColumns(
        {
            "error_code": F.when(unplaced, F.lit(UNPLACED)).when(repeat | told, F.lit(DUPLICATE)).when(missing, F.coalesce(code, F.lit(DOWNLOAD_ERROR))),
            "error_reason": F.when(unplaced, reason).when(
                repeat, repeat_reason(F.col("identifier"), F.col("first_url"), F.col("document_url"))
            )
            .when(told, F.coalesce(reason, F.lit(DUPLICATE_REASON)))
            .when(missing, F.coalesce(reason, F.lit(DOWNLOAD_REASON))),
        }
    ).drop("first_url")


def download_failure(status: Column, exception: Column, message: Column) -> dict[str, Column]:
    """Error columns of a page or document that was not served: status, else exception type."""
    return {
        "error_code": F.coalesce(status.cast("string"), exception),
        "error_reason": F.substring(message, 1, REASON_LIMIT),
    }


def listing_failures(failed_pages: DataFrame) -> DataFrame:
    """Unread listing pages as collection failures of their cell."""
    return failed_pages.select(
        "cell_seq",
        F.lit(None).cast("string").alias("identifier"),
        "url",
        F.coalesce(blank_to_null(F.col("error_code")), F.lit(LISTING_ERROR)).alias("error_code"),
        F.coalesce(blank_to_null(F.col("error_reason")), F.lit(LISTING_REASON)).alias("reason"),
        F.lit(True).alias("is_collection"),
    )

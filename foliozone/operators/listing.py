"""Listing pages: trim each cell's page chain, read rows, set bad rows aside."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.functions import dates, keys, text
from foliozone.session import pieces, small_batches
from foliozone.sources import markup

_ROW = "struct<href:string,link_text:string,date_text:string,reference:string,description:string>"

# Fixed value: how a listing words the count it prints about itself.
_TOTAL = re.compile(r"([\d,]+)\s+results", re.IGNORECASE)

INCOMPLETE = "listing_row_incomplete"
BAD_DATE = "listing_row_bad_date"
NO_END = "listing_page_missing"
NO_END_REASON = "the listing was not read to its end: no page "


def read_listing_rows(pages: DataFrame, profile) -> DataFrame:
    """``(cell_seq, page_number, payload)`` -> the same keys with ``total_text`` and ``rows``.

    Python only locates text in the markup; dates, urls and names are worked out natively.
    """
    selectors = (
        profile.row_selector,
        profile.link_selector,
        profile.date_selector,
        profile.reference_selector,
        profile.description_selector,
    )
    names = ["href", "link_text", "date_text", "reference", "description"]

    def read(batches):
        row, *parts = [markup.compile_selector(s) for s in selectors]

        def read_row(item):
            link, date, reference, description = markup.select_firsts(item, parts)
            return (
                link.attrs["href"] if link else None,
                link.text(" ") if link else None,
                date.stripped_text() if date else None,
                reference.text(" ") if reference else None,
                description.text(" ") if description else None,
            )

        for batch in pieces(batches, 2):
            totals, rows, ends = [], [], [0]
            for payload in batch.column(2):
                page = markup.parse(payload.as_py())
                found = _TOTAL.search(page.text(" "))
                totals.append(found.group(0) if found else None)
                rows += [read_row(item) for item in markup.select(page, row)]
                ends.append(len(rows))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            entries = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)],
                names=["cell_seq", "page_number", "total_text", "rows"],
            )

    small_batches(pages.sparkSession)
    schema = f"cell_seq BIGINT, page_number INT, total_text STRING, rows ARRAY<{_ROW}>"
    return (
        pages.filter(F.col("payload").isNotNull())
        .select("cell_seq", "page_number", "payload")
        .mapInArrow(read, schema)
    )


def trim_chain(pages: DataFrame, is_stop: Column) -> DataFrame:
    """Keep the pages a chained walk would have reached.

    Page n+1 is asked for only if page n was read and held rows, so a cell keeps its pages up to
    and including the first empty or unread one, and nothing behind a gap in the numbering.
    Aggregates first: one narrow row per cell crosses the network, whatever a cell's page count.
    """
    numbers = pages.groupBy("cell_seq", "page_number").agg(F.bool_or(is_stop).alias("stop"))
    # Page numbers are distinct here, so 1..n without a gap means: the i-th smallest number is i.
    before = numbers.alias("p").select("cell_seq", "page_number", "stop")
    follows = numbers.filter(~F.col("stop")).select("cell_seq", (F.col("page_number") + 1).alias("page_number"))
    unreachable = before.filter("page_number > 1").join(follows, ["cell_seq", "page_number"], "left_anti")
    last = unreachable.groupBy("cell_seq").agg(F.min("page_number").alias("cut"))
    return (
        pages.filter("page_number >= 1")
        .join(last, "cell_seq", "left")
        .filter(F.col("cut").isNull() | (F.col("page_number") < F.col("cut")))
        .drop("cut")
    )


def open_chains(walked: DataFrame, is_stop: Column, cells: DataFrame) -> DataFrame:
    """Listing failures of cells whose chain was not read to its end.

    A chain ends in an empty or unread page. If the last page that a walk reached holds rows, the
    next one is missing: it was never captured, or numbering has a gap there. A planned cell
    without any page misses the first.
    """
    last = walked.groupBy("cell_seq").agg(F.max("page_number").alias("last"), F.bool_or(is_stop).alias("ended"))
    missing = last.filter(~F.col("ended")).select("cell_seq", (F.col("last") + 1).cast("int").alias("page_number"))
    unseen = cells.select("cell_seq").distinct().join(last, "cell_seq", "left_anti").select("cell_seq", F.lit(1).alias("page_number"))
    return missing.unionByName(unseen).select(
        "cell_seq",
        "page_number",
        F.lit(None).cast("string").alias("url"),
        F.lit(NO_END).alias("error_code"),
        F.concat(F.lit(NO_END_REASON), F.col("page_number").cast("string")).alias("error_reason"),
    )


def listing_totals(read: DataFrame) -> DataFrame:
    """The reported total per cell, from page one only; cells that print none are absent."""
    total = text.reported_total(F.col("total_text"))
    return (
        read.filter("page_number = 1")
        .select("cell_seq", total.alias("reported_total"))
        .filter("reported_total IS NOT NULL")
    )


def listing_records(read: DataFrame, cells: DataFrame, adapter) -> DataFrame:
    """One row per listing entry with its record columns and, for bad entries, ``reject_reason``.

    A row without link or date, or with a date in no known shape, is never guessed at. Rows of a
    page whose cell is not planned keep a null label and body.
    """
    url = adapter.absolute_url(F.col("href"))
    title = text.collapse_whitespace(F.col("link_text"))
    incomplete = F.col("href").isNull() | F.col("date_text").isNull()
    entries = (
        read.select("cell_seq", "page_number", F.posexplode("rows").alias("position", "entry"))
        .select("cell_seq", "page_number", "position", "entry.*")
        .withColumn("decision_date", dates.parse_date(F.col("date_text")))
    )
    return entries.join(cells.select("cell_seq", "label", "body_code", "body_name"), "cell_seq", "left").select(
        "cell_seq",
        "page_number",
        "position",
        # page and position in one ascending number; an array holds fewer than 2^32 rows
        (F.shiftleft(F.col("page_number").cast("bigint"), 32) + F.col("position")).alias("item_seq"),
        F.coalesce(text.collapse_whitespace(F.col("reference")), title).alias("identifier"),
        "body_code",
        "body_name",
        title.alias("title"),
        F.coalesce(text.collapse_whitespace(F.col("description")), F.lit("")).alias("description"),
        "decision_date",
        url.alias("source_url"),
        adapter.document_url(url).alias("document_url"),
        F.col("label").alias("partition_date"),
        keys.guess_content_type(url).alias("content_type"),
        F.lit(adapter.name).alias("source_name"),
        F.when(incomplete, INCOMPLETE).when(F.col("decision_date").isNull(), BAD_DATE).alias("reject_reason"),
    )

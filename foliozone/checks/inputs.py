"""Captured rows, pages and stored state rendered by Spark from the given tables.

Nothing here filters rows away: every table is read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone.functions import hashing, keys
from foliozone.plans.runs import Workspace
from foliozone.session import make_folder, shared_folder, small_batches, stage
from foliozone.sources.adapter import Body, SiteProfile, SourceAdapter
from foliozone.sources.payloads import write_file, write_folder

SITE = "https://example.test"
RUN_TS = datetime(2025, 1, 1)
YEAR = (date(2024, 1, 1), date(2025, 1, 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapter_for(codes: tuple[str, ...], **markup) -> SourceAdapter:
    bodies = tuple(Body(code, f"Body {code}", str(100 + i)) for i, code in enumerate(codes))
    return SourceAdapter(SiteProfile("example", SITE, bodies, **markup))


ORDERS_SITE = adapter_for(("f", "o", "p"))
# the pages table carries its own markup
PAGES_MARKUP = {
    "content_selectors": ("div.missing div.row", "article"),
    "strip_selectors": ("script", "style", "nav", "footer", ".ad", "h1"),
    "volatile_markers": (r"<!--\s*ad [^>]*-->",),
}


def pages_site(sf_dir: str) -> SourceAdapter:
    """The catalogue of bodies: the language folders of page urls, a fixed list of the tables."""
    return adapter_for(("de", "en", "es", "fr"), **PAGES_MARKUP)


def orders_range(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First day and day after the last, from parquet statistics."""
    row = (
        table(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
        .first()
    )
    return row["a"], row["b"] + timedelta(days=1)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listing records; a customer's orders share one reference, so it repeats."""
    key = F.col("o_orderkey").cast("string")
    identifier = F.concat(F.lit("ORD - "), F.col("o_custkey").cast("string"))
    url = F.concat(
        F.lit(f"{SITE}/en/cases/"), key, F.lit("/ord-"), F.col("o_custkey").cast("string"), F.lit(".html")
    )
    day = F.col("o_orderdate").cast("date")
    body = F.lower("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("item_seq"),
        identifier.alias("identifier"),
        body.alias("body_code"),
        F.concat(F.lit("Body "), body).alias("body_name"),
        identifier.alias("title"),
        F.col("o_orderpriority").alias("description"),
        day.alias("decision_date"),
        url.alias("source_url"),
        url.alias("document_url"),
        F.date_format(day, "yyyy-MM").alias("partition_date"),
        F.lit("text/html").alias("content_type"),
        F.lit("example").alias("source_name"),
        "o_totalprice",
        "o_orderpriority",
    )


def with_cell(records: DataFrame, adapter: SourceAdapter, start: date) -> DataFrame:
    """The ordinal of a record's monthly cell, as the planned grid numbers it."""
    codes = [b.code for b in adapter.bodies()]
    month = F.months_between(F.trunc("decision_date", "MM"), F.lit(start.replace(day=1))).cast("bigint")
    place = F.array_position(F.array(*(F.lit(c) for c in codes)), F.col("body_code")) - 1
    return records.withColumn("cell_seq", month * len(codes) + place)


def order_items(spark: SparkSession, sf_dir: str, start: date, elapsed: str, edited: Column | None = None) -> DataFrame:
    """Orders as captured items with a rendered page; cheap orders failed to download."""
    records = with_cell(order_records(spark, sf_dir), ORDERS_SITE, start)
    mark = F.when(edited, F.lit(" (amended)")).otherwise(F.lit("")) if edited is not None else F.lit("")
    page = F.concat(
        F.lit("<html><body><p>"),
        F.col("o_orderpriority"),
        mark,
        F.lit(f"</p><!-- Elapsed time: {elapsed} --></body></html>"),
    )
    failed = F.col("o_totalprice") < 20000
    return records.select(
        *(c for c in records.columns if not c.startswith("o_")),
        F.when(~failed, F.encode(page, "UTF-8")).alias("payload"),
        F.when(failed & (F.col("description") != "5-LOW"), F.lit("504")).alias("error_code"),
        F.when(failed, F.lit("no answer in time")).alias("error_reason"),
    )


PAGE_BODY = "regexp_extract(url, 'https?://[^/]+/([a-z]+)/', 1)"


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captured items: body from the url's folder, one date per page."""
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit(YEAR[0]), (F.col("page_id") % 366).cast("int"))
    identifier = F.concat(F.lit("PAGE "), F.col("page_id").cast("string"))
    body = F.expr(PAGE_BODY)
    return pages.select(
        F.col("page_id").alias("item_seq"),
        identifier.alias("identifier"),
        body.alias("body_code"),
        F.concat(F.lit("Body "), body).alias("body_name"),
        identifier.alias("title"),
        F.lit("").alias("description"),
        day.alias("decision_date"),
        F.col("url").alias("source_url"),
        F.col("url").alias("document_url"),
        F.date_format(day, "yyyy-MM").alias("partition_date"),
        keys.guess_content_type(F.col("url")).alias("content_type"),
        F.lit("example").alias("source_name"),
        F.encode(F.col("html"), "UTF-8").alias("payload"),
        F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("string").alias("error_reason"),
    )


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_cell(page_records(spark, sf_dir), pages_site(sf_dir), YEAR[0])


#: Files of pages in one folder.
FOLDER_FILES = 4096


def page_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Write every page to a file of its own, a line a row, as a fetcher would; ``page_id, path`` of each.

    Spark's writers would make and commit a folder for every page. Only pages of several rows are
    shuffled, to be written by one task each.
    """
    folder = make_folder(spark, folder)
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    several = stage(pages.groupBy("page_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("page_id").alias("several")), "pages_of_several_rows")
    same = F.col("page_id").eqNullSafe(F.col("several"))
    gathered = pages.join(several, same, "left_semi").repartition("page_id").sortWithinPartitions("page_id")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((key, html or "") for batch in batches for key, html in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        done = []
        for n, (key, lines) in enumerate(groupby(rows, key=lambda row: row[0])):
            if n % FOLDER_FILES == 0:
                yield _named(done)
                done, inside = [], f"{folder}/{TaskContext.get().partitionId()}-{n // FOLDER_FILES}"
                write_folder(inside)
            path = f"{inside}/page_id={key}.html"
            write_file(path, (f"{html}\n".encode() for _, html in lines))
            done.append((key, path))
        yield _named(done)

    named = [rows.mapInArrow(written, "page_id BIGINT, path STRING") for rows in (pages.join(several, same, "left_anti"), gathered)]
    return stage(named[0].unionByName(named[1]), "page_files")


def _named(files: list[tuple[int | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.int64()), pa.array([f[1] for f in files], pa.string())], names=["page_id", "path"])


def re_served(items: DataFrame, which: Column | None = None) -> DataFrame:
    """The same pages served again, with only the volatile marker moved (on some of them)."""
    moved = F.encode(F.regexp_replace(F.decode("payload", "UTF-8"), "<!-- ad ", "<!-- ad 9"), "UTF-8")
    return items.withColumn("payload", moved if which is None else F.when(which, moved).otherwise(F.col("payload")))


def document_rows(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Documents as stored (run 1), and as captured next (run 2): some edited, and the benchmark's items new."""
    edited = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    documents = table(spark, sf_dir, "documents")
    identifier = F.concat(F.lit("DOC-"), F.col("doc_id").cast("string"))
    rows = documents.select(
        F.col("doc_id").alias("item_seq"),
        identifier.alias("identifier"),
        F.col("lang").alias("body_code"),
        (edited if run == 2 else F.col("text")).alias("text"),
    )
    if run == 1:
        return rows
    new = table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + 1_000_000_000).alias("item_seq"),
        F.concat(F.lit("DOC-"), (F.col("item_id") + 1_000_000_000).cast("string")).alias("identifier"),
        F.lit("en").alias("body_code"),
        "text",
    )
    return rows.unionByName(new)


def document_state(rows: DataFrame) -> DataFrame:
    """Document rows with the storage columns of a write."""
    digest = hashing.content_hash(F.encode(F.col("text"), "UTF-8"))
    path = keys.object_key(
        F.lit("example"), F.col("body_code"), F.lit("2024-01"), F.concat(F.lower("identifier"), F.lit(".html"))
    )
    return rows.select(
        "item_seq",
        "identifier",
        "body_code",
        digest.alias("file_hash"),
        digest.alias("content_fingerprint"),
        path.alias("file_path"),
    )


def workspace(spark: SparkSession) -> Workspace:
    """A fresh pair of zones in the shared folder."""
    return Workspace(spark, f"{shared_folder(spark)}/zones/{uuid.uuid4().hex}")

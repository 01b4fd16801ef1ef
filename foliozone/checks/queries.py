"""One query per operator group, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.checks import inputs
from foliozone.checks.inputs import RUN_TS, YEAR, table
from foliozone.functions import dates, hashing, keys, text
from foliozone.operators import accounting, audits, changes, listing, repeats
from foliozone.plans import ingest, periods, runs, transform
from foliozone.session import shared_folder, stage
from foliozone.sources import handoff, zones
from foliozone.sources.adapter import SiteProfile, SourceAdapter, SourceRegistry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: the order dates' half-open range and the bodies seen."""
    orders = table(spark, sf_dir, "orders")
    span = orders.agg(
        F.min(F.col("o_orderdate").cast("date")).alias("a"),
        F.date_add(F.max(F.col("o_orderdate").cast("date")), 1).alias("b"),
        F.array_sort(F.collect_set(F.lower("o_orderstatus"))).alias("codes"),
    )
    body = lambda c, i: F.struct(
        c.alias("code"), F.concat(F.lit("Body "), c).alias("name"), (i + 100).cast("string").alias("external_id")
    )
    return span.select("a", "b", F.transform("codes", body).alias("bodies"))


def _plan(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    planned = periods.windows_of(_bounds(spark, sf_dir), F.col("a"), F.col("b"), size)
    return planned.select(
        "window_seq",
        F.col("start").alias("window_start"),
        F.col("end").alias("window_end"),
        "label",
        dates.last_included_day(F.col("end")).alias("last_day"),
    )


@query
def plan_monthly(spark, sf_dir):
    return _plan(spark, sf_dir, "monthly")


@query
def plan_weekly(spark, sf_dir):
    return _plan(spark, sf_dir, "weekly")


@query
def plan_daily(spark, sf_dir):
    return _plan(spark, sf_dir, "daily")


@query
def plan_single_window(spark, sf_dir):
    """The window each order date would open, in all three sizes."""
    day = F.col("d")
    columns = [day]
    for size in dates.SIZES:
        columns += [
            dates.next_boundary(day, size).alias(f"{size}_end"),
            dates.period_label(day, size).alias(f"{size}_label"),
        ]
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct().select(*columns)


@query
def assign_period(spark, sf_dir):
    """Every order's month and week inside a ragged range; outside it both are null."""
    first, after = inputs.orders_range(spark, sf_dir)
    start, end = F.lit(first + timedelta(days=17)), F.lit(after - timedelta(days=5))
    day = F.col("o_orderdate").cast("date")
    month = dates.window_of(day, start, end, "monthly")
    week = dates.window_of(day, start, end, "weekly")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month["label"].alias("month_label"),
        month["start"].alias("month_start"),
        month["end"].alias("month_end"),
        week["label"].alias("week_label"),
        week["start"].alias("week_start"),
        week["end"].alias("week_end"),
    )


@query
def events_per_period(spark, sf_dir):
    """Events per daily window and type; windows without events do not appear."""
    day = F.col("ts").cast("date")
    window = dates.window_of(day, F.lit(YEAR[0]), F.lit(YEAR[1]), "daily")
    return (
        table(spark, sf_dir, "events")
        .groupBy(window["label"].alias("label"), "event_type")
        .agg(F.count("*").alias("events"))
    )


def _grid(spark, sf_dir, size="monthly") -> DataFrame:
    return periods.cells_of(_bounds(spark, sf_dir), F.col("a"), F.col("b"), size, F.col("bodies"))


def _renamed(cells: DataFrame) -> DataFrame:
    return cells.withColumnsRenamed({"start": "window_start", "end": "window_end"})


@query
def cell_grid(spark, sf_dir):
    return _renamed(_grid(spark, sf_dir, "weekly"))


@query
def coverage_grid(spark, sf_dir):
    covered = periods.coverage(_grid(spark, sf_dir), inputs.order_records(spark, sf_dir))
    return covered.select("cell_seq", "label", "body_code", "records")


@query
def missing_cells(spark, sf_dir):
    """Grid cells of a longer range that hold no record."""
    grid = periods.cells_of(
        _bounds(spark, sf_dir), F.add_months("a", -3), F.add_months("b", 3), "monthly", F.col("bodies")
    )
    return periods.missing_cells(grid, inputs.order_records(spark, sf_dir)).select("cell_seq", "label", "body_code")


@query
def backfill_grid(spark, sf_dir):
    """Orders held per cell of the fixed-origin weekly grid, order dates moved onto its years."""
    moved = 20 * 365 + 5
    _, after = inputs.orders_range(spark, sf_dir)
    grid = periods.backfill_cells(spark, inputs.ORDERS_SITE, after + timedelta(days=moved), "weekly")
    day = F.date_add("decision_date", moved)
    sunday = F.date_sub(day, F.dayofweek(day) - 1)
    held = inputs.order_records(spark, sf_dir).withColumn("partition_date", dates.period_label(sunday, "weekly"))
    return periods.coverage(grid, held).select(
        "cell_seq", F.col("start").alias("window_start"), "label", "body_code", "records"
    )


@query
def request_frontier(spark, sf_dir):
    """Listing urls for the pages each cell's records fill at ten a page, plus the empty one behind."""
    cells = periods.coverage(_grid(spark, sf_dir), inputs.order_records(spark, sf_dir))
    pages = (F.ceil(F.col("records") / 10) + 1).cast("int")
    return periods.request_frontier(cells, inputs.ORDERS_SITE, pages).select("cell_seq", "page_number", "url")


@query
def date_parse(spark, sf_dir):
    """Order dates written in the accepted shapes and in shapes that must be refused."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    shapes = [
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "dd-MM-yyyy"),
        F.concat(F.lit("\xa0\t"), F.date_format(day, "d/M/yyyy"), F.lit(" \n")),
        F.date_format(day, "yyyy/MM/dd"),
        F.concat(F.lit("31/02/"), F.date_format(day, "yyyy")),
        F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit("x")),
    ]
    raw = F.element_at(F.array(*shapes), (key % len(shapes)).cast("int") + 1)
    parsed = F.col("parsed")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", raw.alias("raw"))
        .withColumn("parsed", dates.parse_date(F.col("raw")))
        .select(
            "o_orderkey",
            "raw",
            "parsed",
            dates.format_site_date(parsed).alias("site_date"),
            dates.from_utc_midnight(dates.utc_midnight(parsed)).alias("round_trip"),
        )
    )


@query
def text_normalise(spark, sf_dir):
    """Whole document texts with ragged white space put in, tidied in four ways."""
    ragged = F.concat(
        F.lit("\u2003 \x1c"),
        F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(". \t\f")), F.lit(", "), F.lit(",\n\n\n\n\xa0")),
        F.lit("\xa0\n"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.collapse_whitespace(ragged)).alias("collapsed"),
        F.md5(text.collapse_blank_lines(ragged)).alias("fewer_blank_lines"),
        F.md5(text.slugify_identifier(ragged)).alias("slug"),
        F.md5(text.remove_whitespace(ragged)).alias("without_space"),
    )


@query
def object_keys(spark, sf_dir):
    """Every name and key the two zones give a page."""
    pages = inputs.page_records(spark, sf_dir)
    url, identifier = F.col("document_url"), F.col("identifier")
    served = F.when(F.col("item_seq") % 3 == 0, F.lit(" Application/PDF ; q=1")).otherwise(F.lit(""))
    filename = keys.landing_filename(url, identifier)
    landing = keys.object_key(F.col("source_name"), F.col("body_code"), F.col("partition_date"), filename)
    content_type = keys.served_content_type(served, F.col("content_type"))
    curated = keys.object_key(
        F.col("source_name"), F.col("body_code"), F.col("partition_date"), keys.curated_filename(identifier, landing)
    )
    path = F.regexp_replace(url, "^https?://[^/]+", "")
    href = F.when(F.col("item_seq") % 2 == 0, path).otherwise(url)
    return pages.select(
        F.col("item_seq").alias("page_id"),
        keys.storage_id(F.col("body_code"), identifier).alias("storage_id"),
        landing.alias("landing_key"),
        curated.alias("curated_key"),
        keys.key_filename(landing).alias("key_filename"),
        keys.path_extension(url).alias("url_extension"),
        keys.extension_for(content_type, url).alias("extension"),
        keys.guess_content_type(url).alias("guessed_type"),
        content_type.alias("content_type"),
        keys.is_html(content_type).alias("is_html"),
        keys.absolute_url(href, inputs.SITE).alias("absolute_url"),
        keys.handoff_filename(
            text.slugify_identifier(identifier), F.col("item_seq"), keys.extension_for(content_type, url)
        ).alias("handoff_name"),
    )


@query
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", hashing.content_hash(F.encode("text", "UTF-8")).alias("file_hash")
    )


@query
def hash_parse(spark, sf_dir):
    """Stored hashes, some missing or without algorithm, and the fingerprint they fall back to."""
    digest = hashing.content_hash(F.encode("text", "UTF-8"))
    key = F.col("doc_id")
    fingerprint = F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, F.lit("")).when(
        key % 4 == 2, F.substring(digest, 8, 64)
    ).otherwise(F.concat(F.lit("old:"), F.substring(digest, 8, 8)))
    file_hash = F.when(key % 5 == 0, F.lit("none")).otherwise(digest)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        hashing.parse_hash(fingerprint).alias("parsed"),
        hashing.comparison_fingerprint(fingerprint, file_hash).alias("compared"),
    )


@query
def volatile_fingerprint(spark, sf_dir):
    """Both hashes of every page: as served, and with the volatile marker removed from HTML."""
    adapter = inputs.pages_site(sf_dir)
    payload = F.col("payload")
    content_type = F.when(F.col("item_seq") % 5 == 0, F.lit("application/pdf")).otherwise(F.lit("TEXT/HTML; charset=x"))
    return inputs.page_records(spark, sf_dir).select(
        F.col("item_seq").alias("page_id"),
        hashing.content_hash(payload).alias("file_hash"),
        hashing.content_hash(adapter.normalise(payload, content_type)).alias("content_fingerprint"),
    )


@query
def rerun_churn(spark, sf_dir):
    """Pages served twice with the marker moved on every second one: rewrites by hash and by fingerprint."""
    adapter = inputs.pages_site(sf_dir)
    pages = inputs.page_items(spark, sf_dir)
    again = inputs.re_served(pages, F.col("item_seq") % 2 == 0)

    def state(items: DataFrame, fingerprint: Column) -> DataFrame:
        return items.select(
            "cell_seq",
            "body_code",
            "identifier",
            hashing.content_hash(fingerprint).alias("content_fingerprint"),
            F.col("identifier").alias("file_path"),
            "error_code",
        )

    def churn(flag: str, fingerprint: Column) -> DataFrame:
        stored = state(pages, fingerprint).withColumn("file_hash", F.lit(""))
        return audits.rerun_churn(
            changes.detect_changes(state(again, fingerprint), changes.stored_state(stored)), flag
        )

    payload = F.col("payload")
    return churn("file_hash", payload).unionByName(
        churn("content_fingerprint", adapter.normalise(payload, F.lit("text/html")))
    )


@query
def reported_total(spark, sf_dir):
    """Counts printed in listing text, with thousands marks; a lone '1 result' is no total."""
    key = F.col("o_orderkey")
    printed = F.format_number(key * 3700000, 0)
    shown = (
        F.when(key % 4 == 0, F.concat(F.lit("Showing 1 of "), printed, F.lit(" \n Results found")))
        .when(key % 4 == 1, F.concat(printed, F.lit("\xa0results, then 5 results")))
        .when(key % 4 == 2, F.lit("1 result"))
        .otherwise(F.concat(F.lit("total "), printed))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.reported_total(shown).alias("reported_total"))


def _order_capture(spark, sf_dir) -> handoff.Capture:
    """Orders as a hand-off: every item, a total where it is even, an unread page for one body's cells."""
    start, _ = inputs.orders_range(spark, sf_dir)
    items = inputs.order_items(spark, sf_dir, start, "0")
    per_cell = items.groupBy("cell_seq", "body_code").agg(F.count("*").alias("n"))
    totals = per_cell.select("cell_seq", F.when(F.col("n") % 2 == 0, F.col("n")).alias("reported_total"))
    busy = per_cell.filter("body_code = 'o'").select(
        "cell_seq",
        F.lit(5).alias("page_number"),
        F.concat(F.lit(f"{inputs.SITE}/en/search/?pageNumber=5&cell="), F.col("cell_seq").cast("string")).alias("url"),
        F.when(F.col("n") % 2 == 0, F.lit("504")).alias("error_code"),
        F.when(F.col("n") % 3 == 0, F.lit("no answer in time")).otherwise(F.lit("")).alias("error_reason"),
    )
    return handoff.Capture.of(spark, items, totals, busy)


def _read_handoff(spark, sf_dir) -> handoff.Capture:
    """Write the hand-off as JSON lines to the shared folder and read it back."""
    import uuid

    path = f"{shared_folder(spark)}/handoff/{uuid.uuid4().hex}"
    handoff.to_lines(_order_capture(spark, sf_dir)).write.json(path)
    return handoff.split_lines(handoff.read_lines(spark, path))


@query
def captured_split(spark, sf_dir):
    """Record rows of the hand-off after the round trip through JSON lines."""
    return _read_handoff(spark, sf_dir).items.select(
        "cell_seq",
        "item_seq",
        "identifier",
        "body_code",
        "decision_date",
        "document_url",
        "error_code",
        "error_reason",
    )


@query
def handoff_bad_lines(spark, sf_dir):
    """A hand-off with cut lines and untyped rows: cut ones are failures, untyped ones records."""
    import uuid

    lines = handoff.to_lines(handoff.Capture.of(spark, inputs.order_items(spark, sf_dir, inputs.orders_range(spark, sf_dir)[0], "0")))
    kind = F.when(F.col("item_seq") % 4 == 1, F.lit(None)).when(F.col("item_seq") % 4 == 2, F.lit("note")).otherwise(F.col("row_type"))
    row = F.to_json(F.struct(*(kind.alias(c) if c == "row_type" else F.col(c) for c in lines.columns)))
    path = f"{shared_folder(spark)}/handoff/{uuid.uuid4().hex}"
    lines.select(F.when(F.col("item_seq") % 9 == 0, F.substring(row, 1, 30)).otherwise(row).alias("value")).write.text(path)
    capture = handoff.split_lines(handoff.read_lines(spark, path))
    return capture.items.select("item_seq", F.lit("record").alias("outcome")).unionByName(
        capture.listing_failures.select(F.lit(None).cast("bigint").alias("item_seq"), F.col("error_code").alias("outcome"))
    )


@query
def unplaced_rows(spark, sf_dir):
    """Rows without a cell, of an unknown cell, and with another cell's label: all of them fail."""
    start, end = inputs.orders_range(spark, sf_dir)
    key = F.col("item_seq")
    items = inputs.order_items(spark, sf_dir, start, "0").withColumns(
        {
            "cell_seq": F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, F.col("cell_seq") + 1_000_000).otherwise(F.col("cell_seq")),
            "partition_date": F.when(key % 11 == 0, F.lit("1900-01")).otherwise(F.col("partition_date")),
        }
    )
    cells = periods.plan_cells(spark, inputs.ORDERS_SITE, start, end)
    stored = spark.createDataFrame([], schemas.METADATA)
    result = ingest.plan_ingest(handoff.Capture.of(spark, items), cells, stored, inputs.ORDERS_SITE, start, end)
    return result.failures.filter(F.col("error_code") == repeats.UNPLACED).select("cell_seq", "identifier", "url")


@query
def listing_chain(spark, sf_dir):
    """Listing chains with unread pages, pages of rejects, gaps, and ends that were never captured."""
    key = F.col("item_seq")
    entry = F.concat(
        F.lit('<li class="each-item"><h2 class="title"><a href="'), F.col("document_url"), F.lit('">Case</a></h2>'),
        F.when(F.col("page") % 17 == 4, F.lit("")).otherwise(F.lit('<span class="date">01/02/2024</span>')),
        F.lit("</li>"),
    )
    rows = inputs.order_records(spark, sf_dir).select(F.floor(key / 10).cast("bigint").alias("page"), "document_url", "item_seq")
    filled = rows.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list(entry)), "").alias("entries"))
    empty = filled.select(F.floor(F.col("page") / 10).alias("c")).distinct().filter("c % 2 = 0")
    pages = filled.filter("page % 19 <> 5").select(
        F.floor(F.col("page") / 10).cast("bigint").alias("cell_seq"),
        (F.col("page") % 10 + 1).cast("int").alias("page_number"),
        F.when(F.col("page") % 13 != 3, F.encode("entries", "UTF-8")).alias("payload"),
    ).unionByName(empty.select(F.col("c").cast("bigint").alias("cell_seq"), F.lit(11).alias("page_number"), F.encode(F.lit("<p>0 results</p>"), "UTF-8").alias("payload")))
    none = F.lit(None).cast("string")
    pages = stage(pages.withColumns({"url": none, "error_code": none, "error_reason": none}), "chain_pages")
    cells = filled.select(F.floor(F.col("page") / 10).cast("bigint").alias("cell_seq")).distinct().withColumns(
        {"label": F.lit("2024-02"), "body_code": F.lit("f"), "body_name": F.lit("Body f")}
    )
    documents = spark.createDataFrame([], "cell_seq BIGINT, document_url STRING, payload BINARY, served_content_type STRING, error_code STRING, error_reason STRING")
    capture, rejected = ingest.capture_pages(pages, documents, stage(cells, "chain_cells"), inputs.ORDERS_SITE)
    failed = capture.listing_failures.select("cell_seq", "page_number", F.coalesce("error_code", F.lit("unread")).alias("outcome"), F.lit(1).cast("bigint").alias("n"))
    page = F.shiftright("item_seq", 32).cast("int").alias("page_number")
    counts = lambda df, outcome: df.groupBy("cell_seq", page).agg(F.lit(outcome).alias("outcome"), F.count("*").alias("n"))
    return failed.unionByName(counts(capture.items, "records")).unionByName(counts(rejected, "rejected"))


@query
def payload_attach(spark, sf_dir):
    """Pages as files of their own beside a hand-off that names paths: stored objects, and what failed.

    Some rows have no path and some name a file that is not there.
    """
    import uuid

    root = f"{shared_folder(spark)}/handoff/{uuid.uuid4().hex}"
    held = inputs.page_files(spark, sf_dir, f"{root}/documents").withColumnsRenamed({"page_id": "item_seq", "path": "local_path"})
    files = handoff.read_payloads(spark, f"{root}/documents")
    key = F.col("item_seq") % 10
    items = inputs.page_items(spark, sf_dir).drop("payload", "error_code", "error_reason").join(held, "item_seq", "left")
    items = items.withColumns(
        {
            "payload_ref": F.when(key == 8, F.concat("local_path", F.lit(".gone"))).when(key != 9, F.col("local_path")),
            "error_code": F.when(key >= 8, F.lit("504")),
            "error_reason": F.lit(None).cast("string"),
        }
    )
    handoff.to_lines(handoff.Capture.of(spark, items)).write.json(f"{root}/lines")
    capture = handoff.split_lines(handoff.read_lines(spark, f"{root}/lines"), files)
    space = inputs.workspace(spark)
    result = runs.ingest_date_range(space, inputs.pages_site(sf_dir), capture, *YEAR, RUN_TS)
    objects = space.landing.snapshot().objects()
    stored = objects.select("identifier", hashing.content_hash(F.col("payload")).alias("payload_hash"), F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    none = F.lit(None)
    failed = result.failures.select("identifier", none.cast("string").alias("payload_hash"), none.cast("bigint").alias("payload_bytes"))
    return stored.unionByName(failed)


@query
def handoff_totals(spark, sf_dir):
    return _read_handoff(spark, sf_dir).totals


@query
def listing_failures(spark, sf_dir):
    return repeats.listing_failures(_read_handoff(spark, sf_dir).listing_failures)


@query
def download_failures(spark, sf_dir):
    """Events as failed requests: status or exception type, and the reason cut at its limit."""
    message = F.repeat(F.concat(F.col("props"), F.lit(" ")), 60)
    status = F.when(F.col("event_type") == "error", F.lit(503))
    columns = repeats.download_failure(status, F.concat(F.col("event_type"), F.lit("Error")), message)
    return table(spark, sf_dir, "events").select("event_id", *(c.alias(n) for n, c in columns.items()))


@query
def listing_trim(spark, sf_dir):
    """Events as listing pages, ten to a cell: the chain stops at the first error event."""
    pages = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 10).cast("bigint").alias("cell_seq"),
        (F.col("event_id") % 10 + 1).cast("int").alias("page_number"),
        "event_type",
    )
    return listing.trim_chain(pages, F.col("event_type") == "error")


def _listing_pages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders rendered as listing pages of ten entries, and the cells they belong to.

    Entries lose their link, date or reference, or get an impossible date, by order key.
    """
    key = F.col("item_seq")
    href = F.when(key % 2 == 0, F.col("document_url")).otherwise(
        F.regexp_replace("document_url", "^https://[^/]+", "")
    )
    link = F.concat(F.lit('<h2 class="title big"><a href="'), href, F.lit('">Case&nbsp;&amp;  <b>no '), key.cast("string"), F.lit("</b></a></h2>"))
    shown = F.when(key % 13 == 0, F.lit("31/02/2024")).otherwise(F.date_format("decision_date", "dd/MM/yyyy"))
    when = F.concat(F.lit('<span class="date"> '), shown, F.lit(" </span>"))
    entry = F.concat(
        F.lit('<li class="each-item clearfix">'),
        F.when(key % 11 == 0, F.lit("")).otherwise(link),
        F.when(key % 17 == 0, F.lit("")).otherwise(when),
        F.when(key % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<p class="description">'), F.col("description"), F.lit("\t \tcase</p>"))
        ),
        F.when(key % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<span class="refNO"> '), F.col("identifier"), F.lit("</span>"))
        ),
        F.lit("</li>"),
    )
    rows = inputs.order_records(spark, sf_dir).select(
        F.floor(key / 10).cast("bigint").alias("cell_seq"), "item_seq", entry.alias("entry")
    )
    pages = rows.groupBy("cell_seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_seq", "entry"))), lambda e: e["entry"]), "\n").alias("entries"),
        F.count("*").alias("n"),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body><div><p>"), F.col("n").cast("string"), F.lit(" <i>Results</i></p></div><ul>"),
        F.col("entries"), F.lit("</ul></body></html>"),
    )
    cells = pages.select(
        "cell_seq",
        F.concat(F.lit("cell "), F.col("cell_seq").cast("string")).alias("label"),
        F.lit("f").alias("body_code"),
        F.lit("Body f").alias("body_name"),
    )
    return (
        pages.select("cell_seq", F.lit(1).alias("page_number"), F.encode(html, "UTF-8").alias("payload")),
        cells,
    )


def _listing_entries(spark, sf_dir) -> DataFrame:
    pages, cells = _listing_pages(spark, sf_dir)
    return listing.listing_records(inputs.ORDERS_SITE.listing_rows(pages), cells, inputs.ORDERS_SITE)


@query
def listing_rows(spark, sf_dir):
    """Records read back out of rendered listing pages."""
    return (
        _listing_entries(spark, sf_dir)
        .filter("reject_reason IS NULL")
        .select(
            "cell_seq", "position", "identifier", "title", "description", "decision_date", "document_url",
            "partition_date", "content_type",
        )
    )


@query
def listing_rejects(spark, sf_dir):
    """Entries set aside, with the reason; never guessed at."""
    return _listing_entries(spark, sf_dir).filter("reject_reason IS NOT NULL").select(
        "cell_seq", "position", "reject_reason"
    )


@query
def listing_page_totals(spark, sf_dir):
    pages, _ = _listing_pages(spark, sf_dir)
    return listing.listing_totals(inputs.ORDERS_SITE.listing_rows(pages))


@query
def repeat_references(spark, sf_dir):
    """Orders whose reference is already taken in their month and body."""
    start, _ = inputs.orders_range(spark, sf_dir)
    records = inputs.with_cell(inputs.order_records(spark, sf_dir), inputs.ORDERS_SITE, start)
    none = F.lit(None).cast("string")
    items = records.withColumns({"has_payload": F.lit(True), "error_code": none, "error_reason": none})
    settled = repeats.with_failures(repeats.mark_repeats(items))
    return settled.filter("error_code IS NOT NULL").select(
        "cell_seq", "item_seq", "body_code", "identifier", "error_code", "error_reason"
    )


@query
def failure_precedence(spark, sf_dir):
    """Every order's error, if any: repeats first, then failed downloads."""
    start, _ = inputs.orders_range(spark, sf_dir)
    items = inputs.order_items(spark, sf_dir, start, "0").withColumn("has_payload", F.col("payload").isNotNull())
    settled = repeats.with_failures(repeats.mark_repeats(items.drop("payload")))
    return settled.select("item_seq", "error_code")


@query
def change_detection(spark, sf_dir):
    """Next capture of the documents against their stored state."""
    stored = inputs.document_state(inputs.document_rows(spark, sf_dir, 1))
    items = inputs.document_state(inputs.document_rows(spark, sf_dir, 2)).withColumns(
        {"cell_seq": F.lit(0).cast("bigint"), "error_code": F.lit(None).cast("string")}
    )
    decided = changes.detect_changes(items, changes.stored_state(stored))
    return decided.select("identifier", "body_code", "action", "keep_metadata")


def _chain_items(spark, sf_dir) -> DataFrame:
    """Orders as rows of one key across many cells, with few distinct contents and paths."""
    start, _ = inputs.orders_range(spark, sf_dir)
    records = inputs.with_cell(inputs.order_records(spark, sf_dir), inputs.ORDERS_SITE, start)
    content = hashing.content_hash(F.encode(F.substring("o_orderpriority", 1, 1), "UTF-8"))
    first = records.groupBy("cell_seq", "body_code", "identifier").agg(
        F.min_by(content, "item_seq").alias("content_fingerprint"), F.min("item_seq").alias("item_seq")
    )
    return first.withColumns(
        {
            "file_path": F.concat(F.col("identifier"), F.lit("/"), (F.col("cell_seq") % 2).cast("string")),
            "error_code": F.when(F.col("item_seq") % 19 == 0, F.lit("504")),
        }
    )


@query
def multi_cell_chain(spark, sf_dir):
    """One key in several cells of a run: each row is compared with the write before it."""
    items = _chain_items(spark, sf_dir)
    stored = items.groupBy("body_code", "identifier").agg(
        F.max_by("content_fingerprint", "item_seq").alias("stored_fingerprint"),
        F.max_by("file_path", "item_seq").alias("stored_path"),
    )
    return changes.detect_changes(items, stored).select(
        "cell_seq", "body_code", "identifier", "action", "keep_metadata"
    )


def _stored(spark, sf_dir):
    """A zone after two stored runs over the documents; the second holds only what it wrote."""
    zone = inputs.workspace(spark).landing
    _store_documents(zone, inputs.document_rows(spark, sf_dir, 1), None)
    _store_documents(zone, inputs.document_rows(spark, sf_dir, 2), zone.snapshot())
    return zone


def _store_documents(zone, rows: DataFrame, before) -> None:
    before = before or zone.snapshot()
    items = inputs.document_state(rows).withColumns(
        {"cell_seq": F.lit(0).cast("bigint"), "error_code": F.lit(None).cast("string")}
    )
    decided = stage(changes.detect_changes(items, changes.stored_state(before.current())), "documents_decided")
    written = decided.filter("keep_metadata")
    none = [c for c in schemas.RECORD_COLUMNS if c not in ("identifier", "body_code")]
    metadata = changes.stamp(written, F.lit(RUN_TS)).withColumns(
        {c: F.lit(YEAR[0]) if c == "decision_date" else F.lit(None).cast("string") for c in none}
    )
    payloads = rows.select("identifier", "body_code", F.encode("text", "UTF-8").alias("payload"))
    objects = payloads.join(written.select("identifier", "body_code", F.col("file_path").alias("object_key"), "cell_seq"), ["identifier", "body_code"])
    zone.append(
        before,
        objects.withColumns(
            {
                "content_type": F.lit("text/html"), "decision_date": F.lit(YEAR[0]), "source_name": F.lit("example"),
                "kind": F.lit("html"), "period": F.lit("2024-01"),
            }
        ),
        metadata,
    )


@query
def upsert_current(spark, sf_dir):
    """State of a zone after two runs: the newest row per key."""
    return _stored(spark, sf_dir).snapshot().current().select(
        "storage_id", "file_path", "file_hash", "content_fingerprint", "run_seq"
    )


@query
def compacted_state(spark, sf_dir):
    """The same state after compaction and removal of what it replaced, objects read back."""
    zone = _stored(spark, sf_dir)
    zone.compact()
    zone.vacuum()
    after = zone.snapshot()
    held = after.objects().select(F.col("object_key").alias("file_path"), hashing.content_hash(F.col("payload")).alias("payload_hash"))
    return after.current().select("storage_id", "file_path").join(held, "file_path").drop("file_path")


@query
def lookup_by_key(spark, sf_dir):
    """Stored records of labelled and of new documents, asked for under one body: other bodies' keys find nothing."""
    ids = table(spark, sf_dir, "labels").select("doc_id").union(table(spark, sf_dir, "benchmark").select(F.col("item_id") + 1_000_000_000))
    asked = ids.distinct().select(F.lit("en").alias("body_code"), F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")).alias("identifier"))
    return _stored(spark, sf_dir).snapshot().find(asked).select("identifier", "body_code", "file_hash", "run_seq")


@query
def side_by_side_cells(spark, sf_dir):
    """One run per body, all decided on the same empty snapshot: every row is there afterwards."""
    start, end = inputs.orders_range(spark, sf_dir)
    records = inputs.with_cell(inputs.order_records(spark, sf_dir), inputs.ORDERS_SITE, start)
    zone = inputs.workspace(spark).landing
    before = zone.snapshot()
    firsts = records.groupBy("body_code", "identifier").agg(F.min("cell_seq").alias("cell_seq"), F.min_by("document_url", "item_seq").alias("document_url"))
    none = F.lit(None).cast("string")
    rows = firsts.withColumns({c: none for c in (*schemas.RECORD_COLUMNS, "file_path", "file_hash", "content_fingerprint") if c not in firsts.columns})
    rows = stage(rows.withColumn("decision_date", F.lit(start)), "side_by_side")
    for body in inputs.ORDERS_SITE.bodies():
        own = rows.filter(F.col("body_code") == body.code)
        objects = own.withColumns({"object_key": F.col("document_url"), "payload": F.encode("document_url", "UTF-8"), "kind": F.lit("html"), "period": F.lit("2024-01")})
        zone.append(before, objects, changes.stamp(own, F.lit(RUN_TS)))
    return zone.snapshot().current().select("storage_id", F.col("run_seq").cast("int").alias("run_seq"))


@query
def range_scan(spark, sf_dir):
    """The middle of the date range, half-open, oldest first."""
    first, after = inputs.orders_range(spark, sf_dir)
    middle = first + (after - first) // 2
    found = zones.range_scan(inputs.order_records(spark, sf_dir), first + timedelta(days=31), middle, "example")
    return found.select("item_seq", "identifier", "body_code", "decision_date").orderBy("decision_date", "item_seq")


@query
def transform_collect(spark, sf_dir):
    """Stored records of a ragged range, each in the cell of its decision date."""
    first, after = inputs.orders_range(spark, sf_dir)
    start, end = first + timedelta(days=10), after - timedelta(days=10)
    key = F.col("item_seq")
    landing = inputs.order_records(spark, sf_dir).withColumn(
        "file_path",
        F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, F.lit("")).otherwise(F.col("document_url")),
    )
    cells = periods.plan_cells(spark, inputs.ORDERS_SITE, start, end, "weekly")
    found = transform.collect(landing, cells, inputs.ORDERS_SITE, start, end, "weekly")
    return found.select("cell_seq", "label", "item_seq", "body_code")


def _object_ids(spark, sf_dir) -> DataFrame:
    """Objects of the first document run, as stored narrow rows."""
    return inputs.document_state(inputs.document_rows(spark, sf_dir, 1)).select(
        F.col("file_path").alias("object_key"),
        F.lit(1).cast("bigint").alias("run_seq"),
        "body_code",
        "identifier",
        F.lit("text/html").alias("content_type"),
        F.lit("html").alias("kind"),
        F.lit("2024-01").alias("period"),
    )


@query
def object_read(spark, sf_dir):
    """Metadata of every document against the stored objects: a missing object is a failure."""
    records = inputs.document_state(inputs.document_rows(spark, sf_dir, 2)).withColumns(
        {"content_type": F.lit("text/html"), "decision_date": F.lit(YEAR[0])}
    )
    found = transform.with_objects(records, _object_ids(spark, sf_dir))
    return found.select(
        "identifier",
        "body_code",
        "own",
        F.when(F.col("object_run").isNull(), transform.UNREADABLE).alias("error_code"),
    )


@query
def object_exists(spark, sf_dir):
    zone = inputs.workspace(spark).landing
    _store_documents(zone, inputs.document_rows(spark, sf_dir, 1), None)
    asked = inputs.document_state(inputs.document_rows(spark, sf_dir, 2)).select(F.col("file_path").alias("object_key"))
    return zone.snapshot().existing(asked)


@query
def extract_content(spark, sf_dir):
    """Relevant content of every page, as bytes hashed and measured; other types pass through."""
    pages = inputs.page_records(spark, sf_dir).select(
        "item_seq",
        F.when(F.col("item_seq") % 10 == 9, F.lit("application/pdf")).otherwise(F.lit("text/html")).alias("content_type"),
        "payload",
    )
    return inputs.pages_site(sf_dir).extract(pages).select(
        F.col("item_seq").alias("page_id"),
        hashing.content_hash(F.col("payload")).alias("content_hash"),
        F.octet_length("payload").cast("bigint").alias("content_bytes"),
        "extract_error",
    )


@query
def extraction_failures(spark, sf_dir):
    """Pages read with a profile whose container they lack, or which is blank: failures with a reason."""
    adapter = inputs.adapter_for(("en",), content_selectors=("div.container.mb-4 div.row div.col-sm-9",))
    pages = inputs.page_records(spark, sf_dir)
    blank = F.lit('<div class="container mb-4"><div class="row"><div class="col-sm-9"> <script>x</script></div></div></div>')
    html = F.decode(F.col("payload"), "UTF-8")
    filled = F.replace(blank, F.lit("<script>"), F.lit("Upheld.<script>"))
    shown = F.concat(html, F.when(F.col("item_seq") % 3 == 0, blank).when(F.col("item_seq") % 3 == 1, filled).otherwise(F.lit("")))
    rows = pages.select("item_seq", F.lit("text/html").alias("content_type"), F.encode(shown, "UTF-8").alias("payload"))
    return (
        adapter.extract(rows)
        .groupBy(F.coalesce("extract_error", F.lit("extracted")).alias("outcome"))
        .agg(F.count("*").alias("pages"))
    )


@query
def extraction_yield(spark, sf_dir):
    pages = inputs.page_records(spark, sf_dir).select(F.lit("text/html").alias("content_type"), "payload")
    return audits.extraction_yield(pages, inputs.pages_site(sf_dir).extract(pages))


@query
def curated_records(spark, sf_dir):
    """Pages through the second stage, landing state given: keys, hashes and action."""
    adapter = inputs.pages_site(sf_dir)
    cells = periods.plan_cells(spark, adapter, *YEAR, "weekly")
    items = inputs.page_items(spark, sf_dir)
    named = items.withColumn("file_path", keys.object_key(F.lit("example"), F.col("body_code"), F.col("partition_date"), F.concat(F.col("item_seq").cast("string"), F.lit(".HTM"))))
    landing = named.drop("payload").withColumns(
        {"file_hash": F.lit("sha256:0"), "content_fingerprint": F.lit("sha256:0")}
    )
    objects = named.select(
        F.col("file_path").alias("object_key"), "payload", "content_type", "identifier", "decision_date", "source_name",
        F.lit(1).cast("bigint").alias("run_seq"), "cell_seq", "body_code", zones.kind_of(F.col("content_type")).alias("kind"),
        F.col("partition_date").alias("period"),
    )
    stored = spark.createDataFrame([], schemas.METADATA)
    result, _ = transform.plan_transform(
        landing, objects, objects.drop("payload"), cells, stored, adapter, *YEAR, "weekly",
        tuple(b.code for b in adapter.bodies()),
    )
    return result.decided.select("identifier", "body_code", "partition_date", "cell_seq", "file_path", "file_hash", "action")


def _plan_orders(spark, sf_dir) -> ingest.StageResult:
    """Orders against an empty store, with the hand-off's unread pages and totals."""
    start, end = inputs.orders_range(spark, sf_dir)
    capture = _order_capture(spark, sf_dir)
    capture = handoff.Capture(
        capture.items,
        capture.totals,
        capture.listing_failures,
        spark.range(0, 3).select(F.col("id").alias("cell_seq"), F.lit("crawl failed").alias("reason")),
    )
    cells = periods.plan_cells(spark, inputs.ORDERS_SITE, start, end)
    stored = spark.createDataFrame([], schemas.METADATA)
    return ingest.plan_ingest(capture, cells, stored, inputs.ORDERS_SITE, start, end)


@query
def cell_summary(spark, sf_dir):
    return _plan_orders(spark, sf_dir).cell_summary


@query
def run_summary(spark, sf_dir):
    return _plan_orders(spark, sf_dir).run_summary


@query
def run_verdict(spark, sf_dir):
    return accounting.run_verdict([_plan_orders(spark, sf_dir).run_summary])


@query
def failure_list(spark, sf_dir):
    return _plan_orders(spark, sf_dir).failures


@query
def failure_breakdown(spark, sf_dir):
    return accounting.failure_breakdown(_plan_orders(spark, sf_dir).failures)


@query
def summary_lines(spark, sf_dir):
    """Cell summaries in their one-line JSON form."""
    return accounting.as_lines(_plan_orders(spark, sf_dir).cell_summary)


@query
def reference_audit(spark, sf_dir):
    return audits.reference_counts(inputs.order_records(spark, sf_dir))


@query
def repeated_reference_rows(spark, sf_dir):
    return audits.repeated_references(inputs.order_records(spark, sf_dir))


@query
def references_in_several_cells(spark, sf_dir):
    return audits.keys_in_several_cells(inputs.order_records(spark, sf_dir))


@query
def key_collisions(spark, sf_dir):
    """Pages whose landing keys coincide."""
    pages = inputs.page_records(spark, sf_dir).withColumn(
        "file_path",
        keys.object_key(
            F.col("source_name"), F.col("body_code"), F.lit("2024"),
            keys.landing_filename(F.regexp_replace("document_url", r"/\d+(\.html)", "/page$1"), F.col("identifier")),
        ),
    )
    return audits.key_collisions(pages)


@query
def last_object_wins(spark, sf_dir):
    """Of all pages written to one key, the one whose bytes survive."""
    decided = inputs.page_items(spark, sf_dir).select(
        "cell_seq", "item_seq", "identifier",
        F.concat(F.col("body_code"), F.lit("/"), (F.col("item_seq") % 40).cast("string")).alias("file_path"),
        F.when(F.col("item_seq") % 3 == 0, changes.UNCHANGED).otherwise(changes.WRITTEN).alias("action"),
    )
    return changes.keep_last_object(decided, ["cell_seq", "item_seq"]).select("identifier", "file_path", "keep_object")


@query
def catalogue_drift(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    known = nation.select(F.col("n_nationkey").cast("string").alias("external_id"), F.col("n_name").alias("name"))
    seen = nation.select(
        (F.col("n_nationkey") + 3).cast("string").alias("external_id"),
        F.concat(
            F.lit("NATION_"), (F.col("n_nationkey") + 3).cast("string"),
            F.when(F.col("n_regionkey") == 2, F.lit(" (new)")).otherwise(F.lit("")),
        ).alias("name"),
    )
    return audits.catalogue_drift(known, seen)


@query
def observed_catalogue(spark, sf_dir):
    """Nations rendered as search-page filters, one per region, and read back."""
    nation = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    box = F.concat(
        F.lit('<input type="checkbox" value="'), key, F.lit('" id="b'), key, F.lit('"><label for="b'), key, F.lit('"> '),
        F.col("n_name"), F.lit(" </label>"),
    )
    panels = nation.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(box)), "").alias("boxes"))
    html = F.concat(F.lit('<html><label for="x">Year</label><label for="grp"> Body </label><span id="grp">'), F.col("boxes"), F.lit("</span></html>"))
    return audits.observed_bodies(panels.select(F.encode(html, "UTF-8").alias("payload")), inputs.ORDERS_SITE.profile)


@query
def source_union(spark, sf_dir):
    """Two sources in one table, each compared by its own rule."""
    markers = SourceAdapter(SiteProfile("web", inputs.SITE, (), volatile_markers=(r"<!--\s*ad [^>]*-->",)))
    plain = SourceAdapter(SiteProfile("archive", inputs.SITE, (), volatile_markers=(r"[0-9]+",)))
    registry = SourceRegistry().add(markers).add(plain)
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("row_id"), F.encode("html", "UTF-8").alias("payload"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.encode("text", "UTF-8").alias("payload"))
    rows = registry.union({"web": pages, "archive": documents})
    fingerprint = hashing.content_hash(
        registry.normalise(F.col("source_name"), F.col("payload"), F.lit("text/html"))
    )
    return rows.select("source_name", "row_id", fingerprint.alias("content_fingerprint"))


@query
def ingest_run(spark, sf_dir):
    """Two stored runs over all orders; the summary per cell of the second.

    In between, render times moved everywhere, one priority's pages were amended, and the first
    run had not yet seen the second half of the range.
    """
    start, end = inputs.orders_range(spark, sf_dir)
    middle = start + (end - start) // 2
    space = inputs.workspace(spark)
    known = inputs.order_items(spark, sf_dir, start, "0")
    before = stage(known.filter(F.col("decision_date") < F.lit(middle)), "first_capture")
    after = stage(
        inputs.order_items(spark, sf_dir, start, "0.27", F.col("o_orderpriority") == "2-HIGH"), "second_capture"
    )
    runs.ingest_date_range(space, inputs.ORDERS_SITE, handoff.Capture.of(spark, before), start, end, RUN_TS)
    second = runs.ingest_date_range(space, inputs.ORDERS_SITE, handoff.Capture.of(spark, after), start, end, RUN_TS)
    return second.cell_summary.select(
        "cell_seq", "partition", "body", "records_found", "records_written", "records_unchanged", "records_failed", "accounted_for"
    )


@query
def rebased_runs(spark, sf_dir):
    """A run over all orders, decided on an empty zone, that meets one which stored half of them meanwhile.

    It ends as if the other had come first: the summary per cell of the late one.
    """
    start, end = inputs.orders_range(spark, sf_dir)
    middle = start + (end - start) // 2
    zone, site = inputs.workspace(spark).landing, inputs.ORDERS_SITE
    cells = periods.plan_cells(spark, site, start, end)
    known = stage(inputs.order_items(spark, sf_dir, start, "0").filter(F.col("decision_date") < F.lit(middle)), "first_capture")
    late = stage(inputs.order_items(spark, sf_dir, start, "0.27", F.col("o_orderpriority") == "2-HIGH"), "second_capture")
    capture, before = handoff.Capture.of(spark, late), zone.snapshot()
    settled = ingest.settle(late, cells, site)
    outcomes = ingest.checked(settled, before.current())
    ingest.ingest(zone, handoff.Capture.of(spark, known), cells, site, start, end, RUN_TS)
    decided = ingest.store(zone, before, capture, settled, outcomes, cells, site, RUN_TS)
    result = ingest.account(decided, cells, ingest.collection_failures(capture), capture.totals, ingest.STAGE, site.name, start, end, "document_url")
    return result.cell_summary.select(
        "cell_seq", "partition", "body", "records_found", "records_written", "records_unchanged", "records_failed", "accounted_for"
    )


def _pages_run(spark, sf_dir, repeat: bool):
    space = inputs.workspace(spark)
    adapter = inputs.pages_site(sf_dir)
    items = inputs.page_items(spark, sf_dir).withColumn(
        # the two file names a listing could share within a cell
        "document_url", F.regexp_replace("document_url", r"/\d+\.html", "/page.html")
    )
    served = stage(items, "pages_capture")
    out = runs.run(space, adapter, handoff.Capture.of(spark, served), *YEAR, RUN_TS)
    if repeat:
        again = stage(inputs.re_served(served), "pages_again")
        out = runs.run(space, adapter, handoff.Capture.of(spark, again), *YEAR, RUN_TS)
    return space, out


@query
def transform_run(spark, sf_dir):
    """The curated zone after both stages over all pages, shared file names included."""
    space, _ = _pages_run(spark, sf_dir, repeat=False)
    return space.curated.snapshot().current().select(
        "storage_id", "partition_date", "file_path", "file_hash", "content_fingerprint", "content_type"
    )


@query
def curated_objects(spark, sf_dir):
    """Stored objects of the curated zone: every metadata row's bytes are there and hash to it."""
    space, _ = _pages_run(spark, sf_dir, repeat=False)
    return space.curated.snapshot().objects().select(
        "object_key", hashing.content_hash(F.col("payload")).alias("payload_hash")
    )


@query
def full_run(spark, sf_dir):
    """Both stages twice over all pages; only volatile markers moved. Summaries of the second time."""
    _, (first, second, _) = _pages_run(spark, sf_dir, repeat=True)
    return first.run_summary.unionByName(second.run_summary).drop("duration_seconds")


@query
def single_cell(spark, sf_dir):
    """One cell through the one-cell entry point: the first month of the first body."""
    start, _ = inputs.orders_range(spark, sf_dir)
    first, end = periods.window_starting_at(start, "monthly")
    items = inputs.order_items(spark, sf_dir, start, "0")
    inside = items.filter((F.col("cell_seq") == 0) & dates.contains(F.col("decision_date"), F.lit(first), F.lit(end)))
    space = inputs.workspace(spark)
    captured = handoff.Capture.of(spark, stage(inside, "cell_capture"))
    result = runs.ingest_single_cell(space, inputs.ORDERS_SITE, captured, start, "f", RUN_TS)
    return result.cell_summary


@query
def single_cell_transform(spark, sf_dir):
    """The second stage of one cell, over a landing zone that holds all pages: January of one body."""
    space, adapter = inputs.workspace(spark), inputs.pages_site(sf_dir)
    items = inputs.page_items(spark, sf_dir).withColumn("document_url", F.regexp_replace("document_url", r"/\d+\.html", "/page.html"))
    runs.ingest_date_range(space, adapter, handoff.Capture.of(spark, stage(items, "pages_capture")), *YEAR, RUN_TS)
    return runs.transform_single_cell(space, adapter, YEAR[0], "en", RUN_TS).cell_summary

"""Stage one: captured rows and pages into the landing zone."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.functions import hashing, keys
from foliozone.operators import accounting, changes, listing, repeats
from foliozone.plans.periods import join_cells
from foliozone.session import stage
from foliozone.sources.adapter import SourceAdapter
from foliozone.sources.handoff import Capture, captured_rows
from foliozone.sources.payloads import Payloads, RowPayloads, prints_of
from foliozone.sources.zones import OBJECT_FOLDERS, CommitConflict, Snapshot, Zone, kind_of, period_of

STAGE = "ingest"
#: The order of captured rows.
PLACE = ["cell_seq", "item_seq"]


@dataclass(frozen=True)
class StageResult:
    """The tables one stage hands back; all narrow."""

    decided: DataFrame
    cell_summary: DataFrame
    run_summary: DataFrame
    failures: DataFrame
    rejects: DataFrame | None = None


def fingerprinted(items: DataFrame, cells: DataFrame, adapter: SourceAdapter, payloads: Payloads | None = None) -> DataFrame:
    """Captured rows without their payloads: both hashes and the landing key, taken where the bytes are."""
    if payloads is None:
        payload = F.col("payload")
        file_hash, fingerprint = hashing.content_hash(payload), hashing.content_hash(adapter.normalise(payload, F.col("content_type")))
        found, kept = items, []
    else:
        # narrow rows meet narrow prints
        found, kept = items.join(payloads.prints(adapter, items), "payload_ref", "left"), ["payload_ref", "payload_bytes"]
        payload = file_hash = F.col("file_hash")
        fingerprint = F.when(keys.is_html(F.col("content_type")), F.col("html_hash")).otherwise(file_hash)
    named = found.select(
        "cell_seq",
        "item_seq",
        *schemas.RECORD_COLUMNS,
        "error_code",
        "error_reason",
        *kept,
        payload.isNotNull().alias("has_payload"),
        file_hash.alias("file_hash"),
        fingerprint.alias("content_fingerprint"),
        F.monotonically_increasing_id().alias("row_id"),  # kept once staged
    ).join(_named_cells(cells), "cell_seq", "left")
    return (
        named.withColumn("file_path", _landing_key(adapter))
        .withColumns(
            {
                "error_code": F.when(placed_row(), F.col("error_code")).otherwise(repeats.UNPLACED),
                "error_reason": F.when(placed_row(), F.col("error_reason")).otherwise(repeats.UNPLACED_REASON),
            }
        )
        .drop("cell_label", "cell_body")
    )


def _named_cells(cells: DataFrame) -> DataFrame:
    return cells.select("cell_seq", F.col("label").alias("cell_label"), F.col("body_code").alias("cell_body"))


def placed_row() -> Column:
    """Whether a row's cell is planned and is the one that the row itself names.

    Ordinals mean nothing across grids, so the label and body that a row carries have to agree;
    a row that carries none goes by its ordinal.
    """
    label = F.coalesce("partition_date", "cell_label") == F.col("cell_label")
    body = F.coalesce("body_code", "cell_body") == F.col("cell_body")
    return F.coalesce(label & body, F.lit(False))


def _landing_key(adapter: SourceAdapter):
    return keys.object_key(
        F.lit(adapter.name),
        F.col("cell_body"),
        F.col("cell_label"),
        keys.landing_filename(F.col("document_url"), F.col("identifier")),
    )


def reachable(capture: Capture) -> Capture:
    """A dead cell brings nothing home: what it left behind is discarded with it."""
    dead = capture.dead_cells.select("cell_seq").distinct()

    def alive(df: DataFrame) -> DataFrame:
        return df.join(dead, "cell_seq", "left_anti")

    rejects = None if capture.rejects is None else alive(capture.rejects)
    return Capture(
        alive(capture.items), alive(capture.totals), alive(capture.listing_failures), capture.dead_cells, capture.payloads, rejects
    )


def settle(items: DataFrame, cells: DataFrame, adapter: SourceAdapter, payloads: Payloads | None = None) -> DataFrame:
    """Captured rows with their failures: all that can be said without the stored state.

    Payloads are read in one pass without a shuffle, for their hashes. Everything after that
    works on the staged narrow rows.
    """
    return repeats.with_failures(repeats.mark_repeats(stage(fingerprinted(items, cells, adapter, payloads), "ingest_rows")))


def checked(settled: DataFrame, stored: DataFrame) -> DataFrame:
    """The outcome of every captured row, over all cells at once."""
    return stage(changes.detect_changes(settled, changes.stored_state(stored)), "ingest_decided")


def decide(items: DataFrame, cells: DataFrame, stored: DataFrame, adapter: SourceAdapter, payloads: Payloads | None = None) -> DataFrame:
    return changes.keep_last_object(checked(settle(items, cells, adapter, payloads), stored), PLACE)


def rebased(outcomes: DataFrame, settled: DataFrame, before: Snapshot, now: Snapshot) -> DataFrame:
    """The outcomes on a later state of the zone: only keys that a run wrote meanwhile are decided again.

    That run counts as an earlier cell of them, as if it had ended before this one began.
    """
    met = stage(now.since(before).select(*changes.KEY).distinct(), "met_keys")
    stored = changes.stored_state(now.current().join(met, changes.KEY, "left_semi"))
    again = changes.detect_changes(settled.join(met, changes.KEY, "left_semi"), stored)
    return stage(outcomes.join(met, changes.KEY, "left_anti").unionByName(again), "ingest_decided")


def meets(now: Snapshot, before: Snapshot, outcomes: DataFrame) -> bool:
    """Whether a run that came after ``before`` wrote a key that is to be written."""
    if set(now.names) <= set(before.names):
        return False
    own = outcomes.filter("keep_metadata").select(*changes.KEY)
    return not now.since(before).select(*changes.KEY).join(own, changes.KEY, "left_semi").isEmpty()


def collection_failures(capture: Capture) -> DataFrame:
    return repeats.listing_failures(capture.listing_failures).unionByName(
        accounting.dead_cells_as_failures(capture.dead_cells)
    )


def account(
    decided: DataFrame,
    cells: DataFrame,
    collection: DataFrame,
    totals: DataFrame | None,
    stage_name: str,
    source: str,
    start: date,
    end: date,
    failed_url: str,
) -> StageResult:
    summary = accounting.cell_summary(cells, decided, collection, totals, stage_name)
    failed = decided.filter(F.col("action") == changes.FAILED).withColumn("url", F.col(failed_url))
    return StageResult(
        decided,
        summary,
        accounting.run_summary(summary, stage_name, source, start, end),
        accounting.failure_rows(cells, stage_name, failed, collection),
    )


def plan_ingest(
    capture: Capture, cells: DataFrame, stored: DataFrame, adapter: SourceAdapter, start: date, end: date
) -> StageResult:
    """Everything the stage computes, with no zone written."""
    capture = reachable(capture)
    decided = decide(capture.items, cells, stored, adapter, capture.payloads)
    return account(
        decided, cells, collection_failures(capture), capture.totals, STAGE, adapter.name, start, end, "document_url"
    )


def landing_objects(items: DataFrame, cells: DataFrame, adapter: SourceAdapter) -> DataFrame:
    """Captured rows in the shape of stored objects, computed in place from their own columns."""
    named = join_cells(
        items, cells.select("cell_seq", F.col("label").alias("cell_label"), F.col("body_code").alias("cell_body"))
    )
    return named.withColumns(
        {
            "object_key": _landing_key(adapter),
            "period": period_of(F.col("decision_date")),
            "kind": kind_of(F.col("content_type")),
        }
    )


def wanted_objects(decided: DataFrame) -> DataFrame:
    """The objects to be written, all but their bytes."""
    return decided.filter("keep_object").select(
        F.col("file_path").alias("object_key"),
        "content_type",
        "identifier",
        "decision_date",
        "source_name",
        "cell_seq",
        "body_code",
        kind_of(F.col("content_type")).alias("kind"),
        period_of(F.col("decision_date")).alias("period"),
        "payload_ref",
        "payload_bytes",
    )


def ingest(
    zone: Zone,
    capture: Capture,
    cells: DataFrame,
    adapter: SourceAdapter,
    start: date,
    end: date,
    run_ts: datetime,
) -> StageResult:
    """Run the stage: decide on narrow rows, then read payloads once more for the written ones only.

    ``capture.items`` must be a stored table (hand-off or staged), as it is scanned twice. Payloads
    that lie apart from the items are opened by the tasks that write them.
    """
    before = zone.snapshot()
    capture = reachable(capture)
    settled = settle(capture.items, cells, adapter, capture.payloads)
    outcomes = checked(settled, before.current(tuple(b.code for b in adapter.bodies())))
    decided = store(zone, before, capture, settled, outcomes, cells, adapter, run_ts)
    result = account(
        decided, cells, collection_failures(capture), capture.totals, STAGE, adapter.name, start, end, "document_url"
    )
    return replace(result, rejects=capture.rejects)


def store(
    zone: Zone, before: Snapshot, capture: Capture, settled: DataFrame, outcomes: DataFrame, cells: DataFrame, adapter: SourceAdapter, run_ts: datetime
) -> DataFrame:
    """Write what was decided on ``before`` and return what came of every row.

    Where a run that committed meanwhile wrote some of the keys, these are decided again: before
    anything is written if that run has ended by then, else the run's objects are written anew.
    Every round means that another run has ended.
    """
    while True:
        now = zone.snapshot()
        if meets(now, before, outcomes):
            outcomes, before = rebased(outcomes, settled, before, now), now
        decided = changes.keep_last_object(outcomes, PLACE)
        if decided.filter("keep_metadata").isEmpty():
            return decided
        dealt = False
        if capture.payloads is None:
            on = [*PLACE, "document_url"]
            objects = landing_objects(changes.matching(capture.items, decided, on, F.col("keep_object")), cells, adapter)
        else:
            objects, dealt = capture.payloads.attach(wanted_objects(decided), OBJECT_FOLDERS)
        try:
            zone.append(before, objects, changes.stamp(decided.filter("keep_metadata"), F.lit(run_ts)), dealt=dealt)
            return decided
        except CommitConflict:
            now = zone.snapshot()
            outcomes, before = rebased(outcomes, settled, before, now), now


def capture_pages(
    pages: DataFrame, documents: DataFrame, cells: DataFrame, adapter: SourceAdapter
) -> tuple[Capture, DataFrame]:
    """Captured listing pages and documents -> a capture, and the rows set aside.

    ``documents`` holds ``cell_seq, document_url, payload, served_content_type, error_code,
    error_reason``, one row per fetched url and cell. Pages are parsed once and staged; a chain
    that does not end is a listing failure of its cell.

    Documents are hashed in one pass; what several listing rows or cells name by the same url with
    the same bytes is one payload, and rows refer to it. ``documents`` must be a stored table, as
    the written ones are read again.
    """
    spark = pages.sparkSession
    seen = _seen_documents(documents, adapter)
    read = stage(adapter.listing_rows(pages), "listing_rows")
    entries = stage(listing.listing_records(read, cells, adapter), "listing_entries")
    accepted = F.count_if(F.col("reject_reason").isNull())
    yields = entries.groupBy("cell_seq", "page_number").agg(accepted.alias("accepted"))
    was_read = read.select("cell_seq", "page_number", "total_text").withColumn("was_read", F.lit(True))
    narrow = pages.drop("payload").join(was_read, ["cell_seq", "page_number"], "left").join(yields, ["cell_seq", "page_number"], "left")
    # a page that yields no record ends the walk, whatever it lists
    stop = F.col("was_read").isNull() | (F.coalesce("accepted", F.lit(0)) == 0)
    walked = stage(listing.trim_chain(narrow, stop).withColumn("stop", stop), "walked_pages")
    reached = entries.join(walked.select("cell_seq", "page_number").distinct(), ["cell_seq", "page_number"], "left_semi")
    rejected = reached.filter("reject_reason IS NOT NULL")
    records = reached.filter("reject_reason IS NULL").drop("reject_reason", "page_number", "position")
    fetched = records.join(seen, ["cell_seq", "document_url"], "left")
    items = captured_rows(fetched, "payload_ref").drop("payload_bytes", "file_hash", "html_hash")
    items = stage(items, "captured_items")
    failures = walked.filter("was_read IS NULL").select("cell_seq", "page_number", "url", "error_code", "error_reason")
    failures = failures.unionByName(listing.open_chains(walked, F.col("stop"), cells))
    payloads = RowPayloads(documents, seen.filter("payload_ref IS NOT NULL").dropDuplicates(["payload_ref"]))
    return Capture.of(spark, items, listing.listing_totals(walked.filter("was_read")), failures, payloads=payloads, rejects=rejected), rejected


def _seen_documents(documents: DataFrame, adapter: SourceAdapter) -> DataFrame:
    """Fetched documents without their bytes; ``payload_ref``: the first cell that holds the same bytes of the url."""
    prints = stage(documents.select("cell_seq", "document_url", "served_content_type", "error_code", "error_reason", *prints_of(F.col("payload"), adapter)), "document_prints")
    same = ["document_url", "file_hash"]
    held = prints.filter("file_hash IS NOT NULL").groupBy(*same).agg(F.min("cell_seq").alias("first_cell"))
    ref = F.when(F.col("first_cell").isNotNull(), F.struct(F.col("first_cell").alias("cell_seq"), "document_url"))
    return stage(prints.join(held, same, "left").withColumn("payload_ref", ref).drop("first_cell"), "seen_documents")

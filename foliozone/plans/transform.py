"""Stage two: landing documents cleaned, renamed and stored in the curated zone."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.functions import dates, hashing, keys
from foliozone.operators import changes
from foliozone.plans.ingest import StageResult, account
from foliozone.plans.periods import placed
from foliozone.session import stage
from foliozone.sources.adapter import SourceAdapter
from foliozone.sources.zones import HTML, Zone, kind_of, period_of, range_scan, stored_only

STAGE = "transform"

# Error codes of this stage.
UNREADABLE = "landing_object_unreadable"
UNREADABLE_REASON = "landing object not found"
NOT_EXTRACTED = "content_extraction_failed"

VERSION = ["object_key", "object_run"]


def collect(
    landing: DataFrame, cells: DataFrame, adapter: SourceAdapter, start: date, end: date, size: str
) -> DataFrame:
    """Landing records of the range, each in the cell its decision date falls into."""
    inside = stored_only(range_scan(landing, start, end, adapter.name))
    return placed(inside, cells, start, end, size)


def with_objects(collected: DataFrame, object_ids: DataFrame) -> DataFrame:
    """Find each record's object version and its folder; ``own``: the usual case, it wrote it itself.

    Not own: another record overwrote the same key, so these bytes belong to both, or the object
    was stored as another kind. ``object_ids`` holds one narrow row per key.
    """
    found = object_ids.select(
        F.col("object_key").alias("file_path"),
        F.col("run_seq").alias("object_run"),
        F.struct("body_code", "identifier").alias("writer"),
        (F.col("kind") == HTML).alias("object_html"),
        "period",
        F.struct("body_code", "kind", "period").alias("folder"),
    )
    own = (
        (F.col("writer.body_code") == F.col("body_code"))
        & (F.col("writer.identifier") == F.col("identifier"))
        & (F.col("object_html") == F.col("html"))
        & (F.col("period") == period_of(F.col("decision_date")))
    )
    return (
        collected.withColumn("html", keys.is_html(F.col("content_type")))
        .join(found, "file_path", "left")
        .withColumn("own", F.coalesce(own, F.lit(False)))
        .drop("writer", "object_html", "period")
    )


def with_known(needed: DataFrame, stored: DataFrame, adapter: SourceAdapter) -> DataFrame:
    """Add ``landing_version``, and ``known_hash`` where the stored record was made from just that.

    The version names the object's bytes, how they are read and by which extractor, so what came
    out of it is what is stored and needs no second extraction.
    """
    version = F.concat_ws("|", "file_path", F.col("object_run").cast("string"), F.col("html").cast("string"), F.lit(adapter.extractor()))
    before = stored.select(
        *changes.KEY, F.col("landing_version").alias("known_version"), F.col("file_hash").alias("known_hash"), F.col("file_path").alias("known_path")
    )
    made = needed.withColumn("landing_version", F.when(F.col("object_run").isNotNull(), version)).join(before, changes.KEY, "left")
    same = (F.col("known_version") == F.col("landing_version")) & (F.col("known_path") == curated_key(adapter, F.col("label"), F.col("file_path")))
    return made.withColumn("known_hash", F.when(same, F.col("known_hash"))).drop("known_version", "known_path")


def _versions(objects: DataFrame) -> DataFrame:
    return objects.withColumnRenamed("run_seq", "object_run").select(
        *VERSION, "payload", "content_type", "identifier", "body_code", "decision_date", "kind", "period"
    )


def extracted_content(
    needed: DataFrame,
    objects: DataFrame,
    adapter: SourceAdapter,
    start: date,
    end: date,
    body_codes: tuple[str, ...],
) -> DataFrame:
    """Clean every needed object version once: ``object_key, object_run, html, own, payload, extract_error``.

    The usual case reads only the months and bodies of the range and drops stale versions by a
    small id set, so payloads go from the scan into the extractor without a shuffle. Versions
    read on behalf of another record are picked in the same way out of the folders they lie in,
    whose names (a few for each body and month) are collected; each is still extracted only once.
    """
    in_range = _versions(objects).filter(
        F.col("period").between(period_of(F.lit(start)), period_of(F.date_sub(F.lit(end), 1)))
        & F.col("body_code").isin(*sorted(set(body_codes)))
    )
    own_ids = needed.filter("own").select(F.col("file_path").alias("object_key"), "object_run").distinct()
    # every id of the range: the same scan without its payload column
    ids = stage(_wanted(in_range, own_ids), "object_ids")
    columns = [*VERSION, "html", "own", "payload", "content_type", "identifier", "body_code", "decision_date"]
    usual = adapter.extract(
        changes.matching(in_range, ids, VERSION, F.col("wanted"))
        .withColumns({"html": F.col("kind") == HTML, "own": F.lit(True)})
        .select(*columns),
        F.col("html"),
    )
    foreign = needed.filter("NOT own AND object_run IS NOT NULL").select(
        F.col("file_path").alias("object_key"), "object_run", "html", "folder"
    )
    folders = [r["folder"] for r in foreign.select("folder").distinct().collect()]
    if not folders:
        return usual
    named = reduce(and_, (F.col(c).isin(*sorted({f[c] for f in folders})) for c in ("body_code", "kind", "period")))
    shared = _versions(objects).filter(named)
    for html in (True, False):
        # the reader's content type, not the writer's, says whether these are cleaned
        asked = stage(_wanted(shared, foreign.filter(F.col("html") == html).select(*VERSION).distinct()), "foreign_ids")
        if asked.filter("wanted").isEmpty():
            continue
        picked = changes.matching(shared, asked, VERSION, F.col("wanted")).withColumns({"html": F.lit(html), "own": F.lit(False)})
        usual = usual.unionByName(adapter.extract(picked.select(*columns), F.col("html")))
    return usual


def _wanted(versions: DataFrame, ids: DataFrame) -> DataFrame:
    """All version ids of a table with a mark on those in ``ids``."""
    marked = ids.withColumn("mark", F.lit(True))
    return versions.select(*VERSION).join(marked, VERSION, "left").select(
        *VERSION, F.col("mark").isNotNull().alias("wanted")
    )


def curated_key(adapter: SourceAdapter, label: Column, landing_path: Column) -> Column:
    return keys.object_key(
        F.lit(adapter.name),
        F.col("body_code"),
        label,
        keys.curated_filename(F.col("identifier"), landing_path),
    )


def decide(needed: DataFrame, content: DataFrame, stored: DataFrame, adapter: SourceAdapter) -> DataFrame:
    """Outcome of every collected record. ``content`` is narrow here: hashes, no bytes."""
    hashes = content.select(
        F.col("object_key").alias("file_path"), "object_run", "html", "own", "content_hash", "extract_error"
    )
    joined = needed.join(hashes, ["file_path", "object_run", "html", "own"], "left")
    unreadable = F.col("object_run").isNull()
    unclean = F.col("extract_error").isNotNull()
    items = (
        joined.withColumns(
            {
                "content_hash": F.coalesce("content_hash", "known_hash"),
                "error_code": F.when(unreadable, UNREADABLE).when(unclean, NOT_EXTRACTED),
                "error_reason": F.when(unreadable, UNREADABLE_REASON).when(unclean, F.col("extract_error")),
                "failed_url": F.when(unreadable, F.col("file_path")).otherwise(F.col("source_url")),
                "landing_path": F.col("file_path"),
            }
        )
        # cleaned bytes are compared as they are
        .withColumns({"file_hash": F.col("content_hash"), "content_fingerprint": F.col("content_hash")})
        .withColumn("file_path", curated_key(adapter, F.col("label"), F.col("landing_path")))
        .drop("content_hash", "known_hash", "folder", "extract_error", "storage_id", "scraped_at", "run_seq")
    )
    decided = stage(changes.detect_changes(items, changes.stored_state(stored)), "transform_decided")
    return changes.keep_last_object(decided, ["cell_seq", "decision_date", "identifier"])


def hashed(content: DataFrame) -> DataFrame:
    return content.withColumn("content_hash", hashing.content_hash(F.col("payload")))


def plan_transform(
    landing: DataFrame,
    objects: DataFrame,
    object_ids: DataFrame,
    cells: DataFrame,
    stored: DataFrame,
    adapter: SourceAdapter,
    start: date,
    end: date,
    size: str,
    body_codes: tuple[str, ...],
) -> tuple[StageResult, DataFrame]:
    """Decide the stage without writing a zone; also returns the staged content.

    Extraction is the costly step, so records that were made from the same object version before
    are left out of it, and its result is staged and then read twice: hashes for the decision,
    bytes only for what has to be written.
    """
    collected = collect(landing.drop("cell_seq", "landing_version"), cells, adapter, start, end, size)
    needed = stage(with_known(with_objects(collected, object_ids), stored, adapter), "transform_needed")
    unknown = needed.filter("known_hash IS NULL")
    content = stage(hashed(extracted_content(unknown, objects, adapter, start, end, body_codes)), "extracted")
    decided = decide(needed, content, stored, adapter)
    return account_transform(decided, cells, adapter, start, end), content


def account_transform(decided: DataFrame, cells: DataFrame, adapter: SourceAdapter, start: date, end: date) -> StageResult:
    none = decided.sparkSession.createDataFrame(
        [],
        "cell_seq BIGINT, identifier STRING, url STRING, error_code STRING, reason STRING, is_collection BOOLEAN",
    )
    # every record came out of our own store, so the expected total is what was collected
    return account(decided, cells, none, None, STAGE, adapter.name, start, end, "failed_url")


def curated_objects(
    content: DataFrame, decided: DataFrame, adapter: SourceAdapter, start: date, end: date, size: str
) -> DataFrame:
    """Cleaned bytes of the written records, as stored objects.

    A record's own content carries all the columns its curated key is made of, so it is picked
    by a small id set and named in place. Content shared with the record that overwrote the key
    is joined to its readers.
    """
    written = decided.filter("keep_object")
    label = dates.window_of(F.col("decision_date"), F.lit(start), F.lit(end), size)["label"]
    own = content.filter("own AND extract_error IS NULL")
    own_ids = written.filter("own").select(F.col("landing_path").alias("object_key"), "object_run").distinct()
    ids = stage(_wanted(own, own_ids), "curated_ids")
    landing_key = F.col("object_key")
    named = changes.matching(own, ids, VERSION, F.col("wanted")).withColumn(
        "object_key", curated_key(adapter, label, landing_key)
    )
    shared = written.filter("NOT own").select(
        F.col("landing_path").alias("object_key"),
        "object_run",
        "html",
        F.col("file_path").alias("curated"),
        "content_type",
        "identifier",
        "body_code",
        "decision_date",
    )
    columns = ["object_key", "payload", "content_type", "identifier", "body_code", "decision_date"]
    rows = named.select(*columns)
    if not shared.isEmpty():
        bytes_of = content.filter("NOT own").select(*VERSION, "html", "payload")
        rows = rows.unionByName(
            shared.join(bytes_of, [*VERSION, "html"]).withColumn("object_key", F.col("curated")).select(*columns)
        )
    return rows.withColumns(
        {
            "source_name": F.lit(adapter.name),
            "period": period_of(F.col("decision_date")),
            "kind": kind_of(F.col("content_type")),
            "cell_seq": F.lit(None).cast("bigint"),
        }
    )


def transform(
    landing: Zone,
    curated: Zone,
    cells: DataFrame,
    adapter: SourceAdapter,
    start: date,
    end: date,
    run_ts: datetime,
    size: str = "monthly",
    body_codes: tuple[str, ...] | None = None,
) -> StageResult:
    """Run the stage. Landing comes in as tables to read; only ``curated`` is written."""
    source, before = landing.snapshot(), curated.snapshot()
    codes = tuple(b.code for b in adapter.select_bodies(body_codes))
    planned, content = plan_transform(
        source.current(codes),
        source.objects(),
        source.current_objects(),
        cells,
        before.current(codes),
        adapter,
        start,
        end,
        size,
        codes,
    )
    decided = planned.decided
    if not decided.filter("keep_metadata").isEmpty():
        curated.append(
            before,
            curated_objects(content, decided, adapter, start, end, size),
            changes.stamp(decided.filter("keep_metadata"), F.lit(run_ts)),
        )
    return planned

import hashlib
from dataclasses import replace
from datetime import date
from functools import cache
from pathlib import Path

import pytest
from fixtures import ADAPTER, FEB, JAN, NO_ROWS, RUN_TS, THREE_ROWS, decision, entry, listing
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.operators import accounting
from foliozone.plans import ingest, periods, runs
from foliozone.sources.handoff import Capture

URLS = [
    "https://site.example/en/cases/2024/february/case-0001.html",
    "https://site.example/en/cases/2024/january/ab-c-0002.html",
    "https://site.example/en/cases/2024/january/case-0003.html",
]


@pytest.fixture
def workspace(spark, tmp_path):
    return runs.Workspace(spark, str(tmp_path / "zones"))


@cache
def capture(spark, page=decision(), first=THREE_ROWS, dead=(), unread=()):
    """Four cells of January; the first body lists three decisions, the others none."""
    rows = []
    for cell in range(4):
        if cell in dead:
            continue
        if cell in unread:
            rows.append((cell, 1, "https://site.example/?pageNumber=1", None, "504", "no answer in time"))
        elif cell == 0:
            rows += [(0, 1, "u", bytearray(first), None, None), (0, 2, "u", bytearray(NO_ROWS), None, None)]
        else:
            rows.append((cell, 1, "u", bytearray(NO_ROWS), None, None))
    pages = spark.createDataFrame(rows, schemas.LISTING_PAGES)
    documents = spark.createDataFrame(
        [(0, u, bytearray(page), "text/html; charset=utf-8", None, None) for u in URLS],
        "cell_seq BIGINT, document_url STRING, payload BINARY, served_content_type STRING, error_code STRING, error_reason STRING",
    )
    cells = periods.plan_cells(spark, ADAPTER, JAN, FEB)
    got, _ = ingest.capture_pages(pages, documents, cells, ADAPTER)
    if dead:
        gone = spark.createDataFrame([(c, f"crawl failed for cell {c}") for c in dead], schemas.DEAD_CELLS)
        got = replace(got, dead_cells=gone)
    return got


def landing_state(workspace):
    snap = workspace.landing.snapshot()
    objects = {(r["object_key"], r["run_seq"]): bytes(r["payload"]) for r in snap.objects().collect()}
    return objects, sorted(tuple(r) for r in snap.metadata().drop("scraped_at").collect())


def only(df):
    (row,) = df.collect()
    return row


def test_first_run_stores_every_record(spark, workspace):
    result = runs.ingest_date_range(workspace, ADAPTER, capture(spark), "01/01/2024", "01/02/2024", RUN_TS)
    total = only(result.run_summary)
    assert (total["partitions"], total["records_found"], total["records_written"], total["records_failed"]) == (4, 3, 3, 0)
    assert total["accounted_for"] and total["collection_complete"]
    assert result.failures.count() == 0
    objects, metadata = landing_state(workspace)
    assert {k for k, _ in objects} == {f"example_source/first/2024-01/{u.rsplit('/', 1)[1]}" for u in URLS}
    row = workspace.landing.snapshot().current().filter("identifier = 'CASE-0001'").first()
    assert row["storage_id"] == "first:CASE-0001" and row["scraped_at"] == RUN_TS
    assert row["file_hash"] == "sha256:" + hashlib.sha256(decision()).hexdigest() != row["content_fingerprint"]


def test_second_run_writes_nothing_when_only_the_render_time_moved(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    before = landing_state(workspace)
    again = runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision(elapsed="0.31")), JAN, FEB, RUN_TS)
    total = only(again.run_summary)
    assert (total["records_written"], total["records_unchanged"]) == (0, 3)
    assert landing_state(workspace) == before and workspace.landing.snapshot().runs == (1,)


def test_changed_content_is_written_again_and_read_back(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    third = runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision("Dismissed.")), JAN, FEB, RUN_TS)
    assert only(third.run_summary)["records_written"] == 3
    snap = workspace.landing.snapshot()
    assert snap.runs == (1, 2) and snap.current().count() == 3 and snap.metadata().count() == 6
    assert {r["run_seq"] for r in snap.current().collect()} == {2}


def test_one_dead_cell_leaves_the_others_alone(spark, workspace):
    result = runs.ingest_date_range(workspace, ADAPTER, capture(spark, dead=(1,)), JAN, FEB, RUN_TS)
    total = only(result.run_summary)
    assert total["records_written"] == 3 and not total["accounted_for"]
    failure = only(result.failures)
    assert failure["error_code"] == "PartitionIngestionError" and failure["is_collection"] and failure["body"] == "second"
    dead = result.cell_summary.filter("cell_seq = 1").first()
    assert (dead["records_found"], dead["records_failed"], dead["collection_complete"]) == (0, 1, False)


def test_what_a_dead_cell_left_behind_is_discarded(spark, workspace):
    got = replace(capture(spark), dead_cells=spark.createDataFrame([(0, "crawl failed")], schemas.DEAD_CELLS))
    result = runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS)
    first = result.cell_summary.filter("cell_seq = 0").first()
    assert (first["records_found"], first["records_written"], first["records_failed"]) == (0, 0, 1)
    assert workspace.landing.snapshot().runs == ()


def test_an_unread_listing_is_not_green(spark, workspace):
    result = runs.ingest_date_range(workspace, ADAPTER, capture(spark, unread=(0,)), JAN, FEB, RUN_TS)
    first = result.cell_summary.filter("cell_seq = 0").first()
    assert (first["records_found"], first["records_written"]) == (0, 0)
    assert not first["collection_complete"] and not first["accounted_for"]
    assert only(result.failures)["error_code"] == "504"


def test_an_empty_payload_is_stored_and_a_missing_one_fails(spark, workspace):
    got = capture(spark)
    shown = F.when(F.col("identifier") == "CASE-0001", F.lit(b"")).when(F.col("identifier") == "CASE-0003", F.lit(None)).otherwise(F.lit(decision()))
    from foliozone.session import stage

    got = replace(got, items=stage(got.items.withColumn("payload", shown).drop("payload_ref"), "items"), payloads=None)
    total = only(runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS).run_summary)
    assert (total["records_written"], total["records_failed"], total["accounted_for"]) == (2, 1, True)
    empty = workspace.landing.snapshot().objects().filter("identifier = 'CASE-0001'").first()
    assert bytes(empty["payload"]) == b""


def test_transform_cleans_renames_and_leaves_landing_alone(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    before = landing_state(workspace)
    result = runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS)
    total = only(result.run_summary)
    assert (total["records_found"], total["records_written"], total["accounted_for"]) == (3, 3, True)
    assert landing_state(workspace) == before
    stored = {r["object_key"]: bytes(r["payload"]) for r in workspace.curated.snapshot().objects().collect()}
    assert sorted(k.rsplit("/", 1)[1] for k in stored) == ["AB-C-0002.html", "CASE-0001.html", "CASE-0003.html"]
    assert all(b"claim is upheld" in b and b"Return to Search" not in b and b"counter" not in b for b in stored.values())
    for row in workspace.curated.snapshot().current().collect():
        assert row["file_hash"] == row["content_fingerprint"] == "sha256:" + hashlib.sha256(stored[row["file_path"]]).hexdigest()
        assert row["partition_date"] == "2024-01"
    again = runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS)
    assert only(again.run_summary)["records_unchanged"] == 3 and workspace.curated.snapshot().runs == (1,)


def test_extraction_failures_are_contained(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark, b"<html><body>bare</body></html>"), JAN, FEB, RUN_TS)
    result = runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS)
    total = only(result.run_summary)
    assert (total["records_failed"], total["records_written"], total["accounted_for"]) == (3, 0, True)
    assert {(r["error_code"], r["reason"]) for r in result.failures.collect()} == {
        ("content_extraction_failed", "no decision content container found on page")
    }
    assert {r["url"] for r in result.failures.collect()} == set(URLS)


def test_a_lost_landing_object_is_contained(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    snap = workspace.landing.snapshot()
    kept = snap.objects().filter("identifier <> 'CASE-0001'")
    broken = runs.Workspace(spark, workspace.root + "-broken")
    broken.landing.append(broken.landing.snapshot(), kept, snap.current())
    result = runs.transform_date_range(broken, ADAPTER, JAN, FEB, RUN_TS)
    failure = only(result.failures)
    assert failure["error_code"] == "landing_object_unreadable"
    assert failure["url"] == "example_source/first/2024-01/case-0001.html"
    assert only(result.run_summary)["records_written"] == 2


def test_decision_date_not_label_places_a_record(spark, workspace):
    late = listing(entry("LATE", "/en/cases/2024/january/ab-c-0002.html", "15/02/2024"), total="1 result")
    runs.ingest_date_range(workspace, ADAPTER, capture(spark, first=late), JAN, FEB, RUN_TS)
    assert only(runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS).run_summary)["records_found"] == 0
    wider = runs.transform_date_range(workspace, ADAPTER, JAN, date(2024, 3, 1), RUN_TS)
    assert only(wider.run_summary)["records_written"] == 1
    row = only(workspace.curated.snapshot().current())
    # filed under the cell of its date, still labelled as ingested
    assert row["file_path"] == "example_source/first/2024-02/LATE.html" and row["partition_date"] == "2024-01"


def test_repeated_bodies_make_repeated_cells(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    result = runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS, body_codes=("first", "first"))
    rows = [(r["records_found"], r["records_written"], r["records_unchanged"]) for r in result.cell_summary.orderBy("cell_seq").collect()]
    assert rows == [(3, 3, 0), (3, 0, 3)]


def shared_capture(spark):
    """Three records of one cell under one site file name, one of them a PDF."""
    rows = [
        (0, 1, "A", bytearray(decision("one")), "text/html"),
        (0, 2, "B", bytearray(decision("two")), "text/html"),
        (0, 3, "C", bytearray(b"%PDF"), "application/pdf"),
        (0, 4, "D", bytearray(decision("four")), "text/html"),
    ]
    df = spark.createDataFrame(rows, "cell_seq BIGINT, item_seq BIGINT, identifier STRING, payload BINARY, content_type STRING")
    url = F.concat(F.lit("https://site.example/view.html?id="), F.col("identifier"))
    from foliozone.session import stage

    items = df.select(
        "cell_seq", "item_seq", "identifier", F.lit("first").alias("body_code"), F.lit("First Tribunal").alias("body_name"),
        F.col("identifier").alias("title"), F.lit("").alias("description"), F.lit(JAN).alias("decision_date"), url.alias("source_url"),
        url.alias("document_url"), F.lit("2024-01").alias("partition_date"), "content_type", F.lit("example_source").alias("source_name"),
        "payload", F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("string").alias("error_reason"),
    )
    return Capture.of(spark, stage(items, "shared"))


def test_shared_file_names_overwrite_one_object(spark, workspace):
    got = shared_capture(spark)
    assert only(runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS).run_summary)["records_written"] == 4
    (stored,) = workspace.landing.snapshot().objects().collect()
    assert b"four" in bytes(stored["payload"])
    again = only(runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS).run_summary)
    assert (again["records_written"], again["records_unchanged"]) == (0, 4)
    result = runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS)
    assert only(result.run_summary)["records_written"] == 4
    curated = {r["object_key"].rsplit("/", 1)[1]: bytes(r["payload"]) for r in workspace.curated.snapshot().objects().collect()}
    # everyone reads the last bytes; the record that calls them a PDF gets them uncleaned
    assert b"<p>four</p>" in curated["A.html"] and curated["A.html"] == curated["B.html"] == curated["D.html"]
    assert curated["C.html"] == decision("four")


def test_single_cell_and_full_run(spark, workspace):
    items = capture(spark)
    one = runs.ingest_single_cell(workspace, ADAPTER, items, JAN, "first", RUN_TS)
    assert only(one.run_summary)["partitions"] == 1 and only(one.run_summary)["records_written"] == 3
    assert only(runs.transform_single_cell(workspace, ADAPTER, JAN, "second", RUN_TS).run_summary)["records_found"] == 0
    first, second, verdict = runs.run(workspace, ADAPTER, items, JAN, FEB, RUN_TS)
    assert only(first.run_summary)["records_unchanged"] == 3 and only(second.run_summary)["records_written"] == 3
    assert only(verdict)["succeeded"]
    # the second stage runs although the first did not reconcile
    first, second, verdict = runs.run(workspace, ADAPTER, capture(spark, unread=(2,)), JAN, FEB, RUN_TS)
    assert only(second.run_summary)["records_unchanged"] == 3 and not only(verdict)["succeeded"]
    assert workspace.log.read("run_summary").count() == 6
    assert workspace.log.read("failures").count() == 1


def test_an_unfinished_run_is_invisible_and_replaced(spark, workspace, monkeypatch):
    from foliozone.sources.zones import Zone

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Zone, "_publish", die)
        with pytest.raises(RuntimeError, match="lost"):
            runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    assert workspace.landing.snapshot().runs == () and workspace.landing.snapshot().current().count() == 0
    again = runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision("Other.")), JAN, FEB, RUN_TS)
    assert only(again.run_summary)["records_written"] == 3
    payloads = [bytes(r["payload"]) for r in workspace.landing.snapshot().objects().collect()]
    assert len(payloads) == 3 and all(b"Other." in p for p in payloads)


def test_compaction_keeps_the_current_state(spark, workspace):
    for text in ("One.", "Two."):
        runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision(text)), JAN, FEB, RUN_TS)
    before = sorted(tuple(r) for r in workspace.landing.snapshot().current().drop("run_seq").collect())
    workspace.landing.compact()
    snap = workspace.landing.snapshot()
    assert snap.runs == (3,) and snap.objects().count() == 3 and snap.metadata().count() == 3
    assert sorted(tuple(r) for r in snap.current().drop("run_seq").collect()) == before
    assert all(b"Two." in bytes(r["payload"]) for r in snap.objects().collect())
    assert only(runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision("Two.")), JAN, FEB, RUN_TS).run_summary)["records_unchanged"] == 3
    assert only(runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS).run_summary)["records_written"] == 3


def test_point_reads(spark, workspace):
    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    snap = workspace.landing.snapshot()
    asked = spark.createDataFrame([("first", "CASE-0001"), ("second", "CASE-0001")], "body_code STRING, identifier STRING")
    assert [r["storage_id"] for r in snap.find(asked).collect()] == ["first:CASE-0001"]
    # half-open: a decision on the end day is not in the range
    got = snap.in_range(date(2024, 1, 15), date(2024, 1, 31), ("first",), "example_source").collect()
    assert [r["identifier"] for r in got] == ["CASE-0003", "AB - C - 0002"]
    keys = spark.createDataFrame([("example_source/first/2024-01/case-0001.html",), ("x",)], "object_key STRING")
    assert snap.existing(keys).count() == 1


def test_accounting_rules(spark):
    cells = periods.plan_cells(spark, ADAPTER, JAN, FEB)
    outcomes = spark.createDataFrame([(0, "written"), (0, "unchanged"), (0, "failed"), (1, "written")], "cell_seq BIGINT, action STRING")
    totals = spark.createDataFrame([(0, 3), (1, 2)], schemas.TOTALS)
    none = spark.createDataFrame([(2,)], "cell_seq BIGINT")
    summary = accounting.cell_summary(cells, outcomes, none, totals, "ingest")
    rows = {r["cell_seq"]: (r["records_found"], r["records_failed"], r["collection_complete"], r["accounted_for"]) for r in summary.collect()}
    assert rows == {0: (3, 1, True, True), 1: (2, 0, True, False), 2: (0, 1, False, False), 3: (0, 0, True, True)}
    (line,) = accounting.as_lines(accounting.run_summary(summary.filter("cell_seq = 3"), "ingest", "s", JAN, FEB)).collect()
    assert "\n" not in line["line"] and '"accounted_for":true' in line["line"]
    empty = only(accounting.run_summary(summary.limit(0), "ingest", "s", JAN, FEB))
    assert (empty["partitions"], empty["records_found"], empty["accounted_for"]) == (0, 0, True)


def test_overlapping_runs_end_as_if_one_came_first(spark, workspace, monkeypatch):
    """A run of one cell that commits while another is about to: both stay. The same key: decided again."""
    from foliozone.sources.zones import Zone

    def cell(code, name, text=None):
        page = listing(entry(name, f"/en/cases/2024/january/{name}.html"), total="1 result")
        pages = spark.createDataFrame([(0, 1, "u", bytearray(page), None, None), (0, 2, "u", bytearray(NO_ROWS), None, None)], schemas.LISTING_PAGES)
        url = f"https://site.example/en/cases/2024/january/{name}.html"
        documents = spark.createDataFrame([(0, url, bytearray(decision(text or name)), "text/html", None, None)], "cell_seq BIGINT, document_url STRING, payload BINARY, served_content_type STRING, error_code STRING, error_reason STRING")
        cells = periods.plan_cells(spark, ADAPTER, JAN, FEB, body_codes=(code,))
        return ingest.capture_pages(pages, documents, cells, ADAPTER)[0]

    original = Zone._publish

    def overlapped(code, name):
        def publish(self, *args):
            monkeypatch.setattr(Zone, "_publish", original)
            runs.ingest_single_cell(workspace, ADAPTER, cell(code, name), JAN, code, RUN_TS)
            return original(self, *args)

        monkeypatch.setattr(Zone, "_publish", publish)

    overlapped("second", "B")
    runs.ingest_single_cell(workspace, ADAPTER, cell("first", "A"), JAN, "first", RUN_TS)
    snap = workspace.landing.snapshot()
    assert snap.runs == (1, 2) and {r["storage_id"] for r in snap.current().collect()} == {"first:A", "second:B"}
    assert snap.objects().count() == 2
    # the other run stored just this: nothing is left to write
    overlapped("first", "C")
    late = only(runs.ingest_single_cell(workspace, ADAPTER, cell("first", "C"), JAN, "first", RUN_TS).run_summary)
    assert (late["records_unchanged"], late["records_written"], late["accounted_for"]) == (1, 0, True)
    assert workspace.landing.snapshot().runs == (1, 2, 3)
    # the other run stored something else: ours comes after it
    overlapped("first", "D")
    late = only(runs.ingest_single_cell(workspace, ADAPTER, cell("first", "D", "amended"), JAN, "first", RUN_TS).run_summary)
    assert late["records_written"] == 1
    snap = workspace.landing.snapshot()
    assert snap.runs == (1, 2, 3, 4, 5) and snap.current().count() == 4
    assert snap.current().filter("identifier = 'D'").first()["file_hash"] == "sha256:" + hashlib.sha256(decision("amended")).hexdigest()
    # what was written before it was decided again is gone
    folder = Path(snap.root.removeprefix("file:")) / "objects"
    assert len(list(folder.glob("run=*"))) == len(list((folder.parent / "metadata").glob("run=*"))) == 5


def test_a_run_that_is_late_before_it_writes_writes_once(spark, workspace, monkeypatch):
    from foliozone.sources.zones import Zone

    zone, cells = workspace.landing, periods.plan_cells(spark, ADAPTER, JAN, FEB)
    first, late = capture(spark, decision("One.")), capture(spark, decision("Two."))
    before = zone.snapshot()
    settled = ingest.settle(late.items, cells, ADAPTER, late.payloads)
    outcomes = ingest.checked(settled, before.current())
    ingest.ingest(zone, first, cells, ADAPTER, JAN, FEB, RUN_TS)
    appended, original = [], Zone.append
    monkeypatch.setattr(Zone, "append", lambda self, *args, **kwargs: (appended.append(args[0].names), original(self, *args, **kwargs))[1])
    decided = ingest.store(zone, before, late, settled, outcomes, cells, ADAPTER, RUN_TS)
    assert [len(names) for names in appended] == [1] and zone.snapshot().runs == (1, 2)
    assert {r["action"] for r in decided.collect()} >= {"written"}
    # none of its keys: what was decided holds
    assert not ingest.meets(zone.snapshot(), before, outcomes.withColumn("identifier", F.concat("identifier", F.lit("?"))))


def test_vacuum_removes_what_a_compaction_replaced(spark, workspace, tmp_path):
    for text in ("One.", "Two."):
        runs.ingest_date_range(workspace, ADAPTER, capture(spark, decision(text)), JAN, FEB, RUN_TS)
    workspace.landing.compact()
    before = sorted(tuple(r) for r in workspace.landing.snapshot().current().collect())
    assert len(workspace.landing.vacuum()) == 2
    root = tmp_path / "zones" / "landing"
    assert len(list((root / "objects").glob("run=*"))) == len(list((root / "metadata").glob("run=*"))) == 1
    assert sorted(tuple(r) for r in workspace.landing.snapshot().current().collect()) == before
    assert workspace.landing.snapshot().runs == (3,)


def test_rejected_entries_are_logged(spark, workspace):
    bad = listing(entry("CASE-0001", "/en/cases/2024/february/case-0001.html"), entry("NO-DATE", "/en/cases/2024/x.html", day="tomorrow"), entry("NO-LINK", None))
    result = runs.ingest_date_range(workspace, ADAPTER, capture(spark, first=bad), JAN, FEB, RUN_TS)
    kept = {(r["cell_seq"], r["page_number"], r["identifier"]) for r in workspace.log.read("rejects").collect()}
    assert kept == {(0, 1, "NO-DATE"), (0, 1, "NO-LINK")} and result.rejects.filter("reject_reason IS NULL").count() == 0
    assert only(result.run_summary)["records_written"] == 1
    # a dead cell leaves none
    got = replace(capture(spark, first=bad), dead_cells=spark.createDataFrame([(0, "crawl failed")], schemas.DEAD_CELLS))
    assert runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS).rejects.count() == 0


def test_a_run_leaves_nothing_staged(spark, workspace):
    from foliozone import session

    got = capture(spark)
    before = list(session._staged)
    result = runs.ingest_date_range(workspace, ADAPTER, got, JAN, FEB, RUN_TS)
    assert session._staged == before and result.decided.count() == 3
    assert only(result.run_summary)["duration_seconds"] > 0
    assert workspace.log.read("outcomes").filter("action = 'written'").count() == 3


def test_rows_of_another_grid_are_not_taken(spark, workspace):
    """A capture of the whole grid given to a run of its second body: the first body's rows fail."""
    result = runs.ingest_single_cell(workspace, ADAPTER, capture(spark), JAN, "second", RUN_TS)
    assert only(result.run_summary)["records_written"] == 0 and not only(result.run_summary)["accounted_for"] or result.failures.count() == 3
    assert {r["error_code"] for r in result.failures.collect()} == {"row_of_no_planned_cell"}
    assert workspace.landing.snapshot().runs == ()
    (line,) = accounting.failure_lines(result.failures.limit(1)).collect()
    assert '"failed_identifier"' in line["line"] and '"failed_url"' in line["line"]


def test_an_unchanged_rerun_extracts_nothing(spark, workspace, monkeypatch):
    from foliozone.sources.adapter import SourceAdapter

    runs.ingest_date_range(workspace, ADAPTER, capture(spark), JAN, FEB, RUN_TS)
    runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS)
    original, counts = SourceAdapter.extract, []
    monkeypatch.setattr(SourceAdapter, "extract", lambda self, documents, html=None: (counts.append(documents.count()), original(self, documents, html))[1])
    again = only(runs.transform_date_range(workspace, ADAPTER, JAN, FEB, RUN_TS).run_summary)
    assert again["records_unchanged"] == 3 and again["accounted_for"] and set(counts) == {0}
    # another template is another extractor
    other = type(ADAPTER)(replace(ADAPTER.profile, strip_selectors=(*ADAPTER.profile.strip_selectors, "h1")))
    assert only(runs.transform_date_range(workspace, other, JAN, FEB, RUN_TS).run_summary)["records_written"] == 3

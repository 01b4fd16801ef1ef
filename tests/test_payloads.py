"""Payloads that lie apart: dealt by bytes, opened where they are written, in no exchange."""

import hashlib
import re
from datetime import datetime
from pathlib import Path

import pytest
from fixtures import ADAPTER, FEB, JAN, NO_ROWS, decision, entry, listing
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.checks import inputs
from foliozone.checks.queries import QUERIES
from foliozone.plans import ingest, periods, runs
from foliozone.sources import handoff, payloads, zones
from foliozone.sources import handoff as lines

RUN_TS = datetime(2024, 6, 1)
SITE = "https://site.example/en/cases/2024/january"


@pytest.fixture
def workspace(spark, tmp_path):
    return runs.Workspace(spark, str(tmp_path / "zones"))


def test_rows_are_dealt_by_bytes_and_folder(spark, monkeypatch):
    monkeypatch.setattr(payloads, "OPENING", 0)
    monkeypatch.setattr(payloads, "GROUP_ROWS", 50)  # many groups
    sizes = [(f"p{i}", "hot" if i % 3 else f"f{i % 7}", 10 + 90 * (i % 11 == 0)) for i in range(600)]
    sizes += [("big", "g", 5000), ("none", None, 3)]
    rows = spark.createDataFrame(sizes, "payload_ref string, folder string, n bigint")
    dealt = payloads.deal_by_bytes(rows, ["folder"], F.col("n"), 500)
    got = dealt.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(sizes)
    tasks = {}
    for r in got:
        tasks.setdefault(r["task"], []).append(r)
    # one row may reach over the end of a piece
    assert all(sum(r["n"] for r in task if r["payload_ref"] != "big") <= 600 for task in tasks.values())
    total = sum(n for _, _, n in sizes)
    assert len(tasks) >= (total - 5000) // 500
    # a task holds a stretch of few folders; the hot one is in many tasks
    assert max(len({r["folder"] for r in task}) for task in tasks.values()) <= 4
    assert sum(any(r["folder"] == "hot" for r in task) for task in tasks.values()) >= 8


def test_no_rows_are_dealt_to_no_task(spark):
    none = spark.createDataFrame([], "payload_ref string, folder string, n bigint")
    assert payloads.deal_by_bytes(none, ["folder"], F.col("n")).count() == 0


def plans_of(monkeypatch):
    """The plans of everything that is staged or written to a zone from here on."""
    seen = []

    def noting(name, at, owner):
        original = getattr(owner, name)

        def noted(*args, **kwargs):
            mode = args[at]._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            seen.append(args[at]._jdf.queryExecution().explainString(mode))
            return original(*args, **kwargs)

        monkeypatch.setattr(owner, name, noted)

    from foliozone.operators import changes

    for module in (ingest, payloads, changes):
        noting("stage", 0, module)
    noting("_write", 2, zones.Zone)
    noting("_write_metadata", 2, zones.Zone)
    return seen


def moved(plan):
    """What the exchanges of a plan move."""
    return [block for block in re.split(r"\n\n+", plan) if re.match(r"\(\d+\) (Exchange|BroadcastExchange)", block)]


def hand_off(spark, tmp_path, bodies):
    """A hand-off of one cell: (identifier, bytes or None for no path, or '' for a file that is not there)."""
    import json

    folder = tmp_path / "documents"
    folder.mkdir()
    rows = []
    for i, (name, data) in enumerate(bodies.items()):
        path = None if data is None else str(folder / f"{name}.html")
        if data:
            (folder / f"{name}.html").write_bytes(data)
        rows.append(
            {"row_type": "record", "cell_seq": 0, "item_seq": i, "identifier": name, "body_code": "first", "decision_date": "2024-01-15", "document_url": f"{SITE}/{name}.html",
             "source_url": "u", "partition_date": "2024-01", "content_type": "text/html", "source_name": "example_source", "local_path": path, "error_code": None if data else "504"}
        )
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "items.jsonl").write_text("\n".join(map(json.dumps, rows)))
    return lines.split_lines(lines.read_lines(spark, str(tmp_path / "h")), lines.read_payloads(spark, str(folder)))


def test_no_payload_is_in_an_exchange(spark, workspace, tmp_path, monkeypatch):
    capture = hand_off(spark, tmp_path, {"A": decision("a"), "B": decision("b"), "C": None, "D": b""})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for module in ("payloads", "changes"):
        monkeypatch.setattr(f"foliozone.{'sources' if module == 'payloads' else 'operators'}.{module}.BROADCAST_BYTES", -1)
    seen = plans_of(monkeypatch)
    try:
        runs.ingest_date_range(workspace, ADAPTER, capture, JAN, FEB, RUN_TS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [block for plan in seen for block in moved(plan)]
    assert len(exchanges) > 5 and any("payload_ref" in block for block in exchanges)
    assert not [block for block in exchanges if re.search(r"\b(payload|content)#", block)]
    stored = {r["identifier"]: bytes(r["payload"]) for r in workspace.landing.snapshot().objects().collect()}
    assert stored == {"A": decision("a"), "B": decision("b")}


def test_only_what_is_written_is_opened(spark, workspace, tmp_path, monkeypatch):
    capture = hand_off(spark, tmp_path, {"A": decision("a"), "B": decision("b")})
    runs.ingest_date_range(workspace, ADAPTER, capture, JAN, FEB, RUN_TS)
    wanted = []
    original = payloads.FilePayloads.attach
    monkeypatch.setattr(payloads.FilePayloads, "attach", lambda self, rows, folders: wanted.extend(r["identifier"] for r in rows.collect()) or original(self, rows, folders))
    (tmp_path / "documents" / "B.html").write_bytes(decision("b", elapsed="0.5").replace(b"b", b"b"))
    (tmp_path / "documents" / "A.html").write_bytes(decision("changed"))
    total = runs.ingest_date_range(workspace, ADAPTER, capture, JAN, FEB, RUN_TS).run_summary.first()
    assert (total["records_written"], total["records_unchanged"]) == (1, 1) and wanted == ["A"]


def fetched(spark, rows):
    return spark.createDataFrame(rows, "cell_seq BIGINT, document_url STRING, payload BINARY, served_content_type STRING, error_code STRING, error_reason STRING")


def test_listing_rows_share_one_payload(spark, workspace, tmp_path, monkeypatch):
    """A url listed many times, in two cells with the same bytes and in a third with others."""
    url = f"{SITE}/shared.html"
    first = listing(*(entry(f"R{i}", "/en/cases/2024/january/shared.html", "15/01/2024") for i in range(5)), total="5 results")
    one = listing(entry("S", "/en/cases/2024/january/shared.html", "15/01/2024"), total="1 result")
    pages = spark.createDataFrame(
        [(c, n, "u", bytearray(page), None, None) for c, full in enumerate([first, one, one, NO_ROWS]) for n, page in enumerate([full, NO_ROWS][: 1 if full is NO_ROWS else 2], 1)], schemas.LISTING_PAGES
    )
    rows = [(0, url, bytearray(decision("x")), "text/html", None, None), (1, url, bytearray(decision("x")), "", None, None), (2, url, bytearray(decision("y")), "", None, None), (3, url, None, "", "504", "late")]
    seen = plans_of(monkeypatch)
    cells = periods.plan_cells(spark, ADAPTER, JAN, FEB)
    capture, _ = ingest.capture_pages(pages, fetched(spark, rows), cells, ADAPTER)
    # nothing staged carries bytes, and the 1:n join moves hashes
    assert "payload" not in capture.items.columns
    assert not [block for plan in seen for block in moved(plan) if re.search(r"\bpayload#\d+\b(?!.*page_number)", block)]
    refs = {(r["cell_seq"], r["payload_ref"]["cell_seq"]) for r in capture.items.collect()}
    assert refs == {(0, 0), (1, 0), (2, 2)} and capture.payloads.seen.count() == 2
    total = runs.ingest_date_range(workspace, ADAPTER, capture, JAN, FEB, RUN_TS).run_summary.first()
    assert total["records_found"] == 7 and total["records_failed"] == 0
    objects = workspace.landing.snapshot().objects().collect()
    # one object a key: five listing rows of one cell wrote it once
    assert {(r["body_code"], bytes(r["payload"])) for r in objects} == {("first", decision("x")), ("second", decision("x")), ("third", decision("y"))} and len(objects) == 3


def test_every_page_is_a_file_of_its_own_in_few_folders(spark, tmp_path):
    """Rows of one page are lines of its file, a null is an empty line, and a page without a number has a file too."""
    rows = [(i, f"https://h/en/p{i}.html", f"<p>{i}\u00e9</p>") for i in range(300)]
    rows += [(7, "https://h/en/p7.html", "<p>7\u00e9</p>"), (300, "u", None), (301, "u", ""), (None, "u", "none")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    written = inputs.page_files(spark, str(tmp_path), str(tmp_path / "documents")).collect()
    held = {r["page_id"]: Path(r["path"].removeprefix("file:")) for r in written}
    assert len(written) == len(held) == 303 and set(held) == {None, *range(302)}
    want = {i: f"<p>{i}\u00e9</p>\n" for i in range(300)} | {7: "<p>7\u00e9</p>\n" * 2, 300: "\n", 301: "\n", None: "none\n"}
    assert {k: path.read_text(encoding="utf-8") for k, path in held.items()} == want
    files = [p for p in (tmp_path / "documents").rglob("*") if p.is_file()]
    assert sorted(files) == sorted(held.values()) and len({p.parent for p in files}) <= 4


def test_pages_attached_by_path(spark, tmp_path, monkeypatch):
    """Every page has its row: stored whole, without a path, or with a path to nothing."""
    rows = [(i, f"https://h/{'de en es fr'.split()[i % 4]}/p{i}.html", f"<p>{i}</p>" * (i % 50)) for i in range(500)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr("foliozone.checks.queries.shared_folder", lambda spark: str(tmp_path))
    got = sorted(tuple(r) for r in QUERIES["payload_attach"](spark, str(tmp_path)).collect())
    data = {i: f"{html}\n".encode() for i, _, html in rows}
    sha = lambda i: "sha256:" + hashlib.sha256(data[i]).hexdigest()
    assert got == sorted((f"PAGE {i}", sha(i), len(data[i])) if i % 10 < 8 else (f"PAGE {i}", None, None) for i in range(500))
    # the files lie in few folders, and so do not cost a folder and a commit each
    (folder,) = tmp_path.glob("handoff/*/documents")
    assert sum(p.is_dir() for p in folder.iterdir()) <= 8

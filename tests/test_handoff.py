import hashlib
import json

import pytest
from fixtures import ADAPTER
from pyspark.sql import functions as F

from foliozone.sources import handoff, payloads

RECORD = {
    "row_type": "record", "identifier": "CASE-0001", "body_code": "first", "body_name": "First Tribunal",
    "title": "CASE-0001", "description": "A v B", "decision_date": "2024-01-31", "source_url": "https://s/a.html",
    "document_url": "https://s/a.html", "partition_date": "2024-01", "content_type": "text/html",
    "source_name": "example_source", "local_path": None, "error_code": "504", "error_reason": "no answer in time",
}
FAILURE = {"row_type": "listing_failure", "url": "https://s/?pageNumber=3", "page_number": 3, "error_code": "504", "error_reason": None}


def write(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join("  " if r is None else json.dumps(r) for r in rows) + "\n", encoding="utf-8")


def test_rows_are_routed_by_type(spark, tmp_path):
    write(
        tmp_path / "h" / "cell_seq=7" / "items.jsonl",
        {"row_type": "summary", "reported_total": 12}, None, RECORD, FAILURE, {"row_type": "summary", "reported_total": 57},
    )
    capture = handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "h")))
    (item,) = capture.items.collect()
    assert item["payload"] is None and str(item["decision_date"]) == "2024-01-31" and item["cell_seq"] == 7
    assert item["error_code"] == "504"
    # the last summary counts
    assert [tuple(r) for r in capture.totals.collect()] == [(7, 57)]
    assert [(r["cell_seq"], r["url"]) for r in capture.listing_failures.collect()] == [(7, FAILURE["url"])]


def test_a_null_summary_written_last_leaves_no_total(spark, tmp_path):
    write(tmp_path / "h" / "cell_seq=1" / "i.jsonl", {"row_type": "summary", "reported_total": 3}, {"row_type": "summary", "reported_total": None})
    assert handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "h"))).totals.count() == 0


def test_an_absent_handoff_is_an_empty_cell(spark, tmp_path):
    capture = handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "none")))
    assert capture.items.count() == capture.totals.count() == capture.listing_failures.count() == 0


def test_rows_without_a_number_are_numbered_as_written(spark, tmp_path):
    n = 4000
    write(tmp_path / "h" / "cell_seq=0" / "items.jsonl", *({**RECORD, "identifier": f"R{i}"} for i in range(n)))
    write(tmp_path / "h" / "cell_seq=1" / "items.jsonl", *({**RECORD, "identifier": f"R{i}"} for i in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows = handoff.read_lines(spark, str(tmp_path / "h")).select("cell_seq", "item_seq", "identifier").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for cell, size in ((0, n), (1, 50)):
        mine = sorted((r["item_seq"], r["identifier"]) for r in rows if r["cell_seq"] == cell)
        assert [k for _, k in mine] == [f"R{i}" for i in range(size)]
        assert len({s for s, _ in mine}) == size


def test_payloads_are_attached_by_path(spark, tmp_path):
    files = tmp_path / "documents"
    files.mkdir()
    (files / "a b.html").write_bytes(b"\xff<html>")
    (files / "empty.html").write_bytes(b"")
    rows = [
        {**RECORD, "identifier": k, "local_path": path, "error_code": None, "error_reason": None}
        for k, path in (("full", str(files / "a b.html")), ("empty", str(files / "empty.html")), ("none", None), ("gone", str(files / "x.html")))
    ]
    write(tmp_path / "h" / "cell_seq=0" / "items.jsonl", *rows)
    capture = handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "h")), handoff.read_payloads(spark, str(files)))
    prints = capture.payloads.prints(ADAPTER, capture.items)
    known = capture.items.join(prints, "payload_ref").select("identifier", "payload_ref", "payload_bytes", "file_hash", "html_hash")
    # an empty file is a payload, a missing one is not
    sha = lambda data: "sha256:" + hashlib.sha256(data).hexdigest()
    assert {r["identifier"]: (r["payload_bytes"], r["file_hash"]) for r in known.collect()} == {"full": (7, sha(b"\xff<html>")), "empty": (0, sha(b""))}
    held, dealt = capture.payloads.attach(known, ["identifier"])
    assert dealt and {r["identifier"]: bytes(r["payload"]) for r in held.collect()} == {"full": b"\xff<html>", "empty": b""}
    # rows that refer to files keep their path as lines
    assert {r["local_path"] for r in handoff.to_lines(capture).collect()} == {None, str(files / "a b.html"), str(files / "empty.html"), str(files / "x.html")}


def test_many_small_files_are_opened_by_few_tasks(spark, tmp_path):
    for i in range(200):
        folder = tmp_path / "documents" / f"f{i % 3}" / f"deep{i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"a {i}%20#.html").write_bytes(b"x" * i)  # the first is empty
    for hidden in (".hidden", "_hidden", "part._COPYING_"):
        (tmp_path / "documents" / hidden).write_bytes(b"x")
    (tmp_path / "documents" / "_a=b").mkdir()
    (tmp_path / "documents" / "_a=b" / "one.html").write_bytes(b"\xff")
    for place in ("documents", "documents/f*", "documents/_a=b/one.html"):
        path = str(tmp_path / place)
        got = handoff.read_payloads(spark, path)
        usual = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
        assert sorted(got.collect()) == sorted(usual.collect()) and got.schema == usual.schema
    everything = handoff.read_payloads(spark, str(tmp_path / "documents"))
    assert everything.count() == 200 and everything.select(F.spark_partition_id()).distinct().count() == 1


def test_no_folder_of_payloads_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException) as error:
        handoff.read_payloads(spark, str(tmp_path / "none"))
    assert error.value.getCondition() == "PATH_NOT_FOUND"
    (tmp_path / "empty").mkdir()
    assert handoff.read_payloads(spark, str(tmp_path / "empty")).count() == 0


def test_folders_are_listed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(payloads, "LISTING_TASKS", 4)
    for i in range(40):
        (tmp_path / "d" / f"page_id={i}").mkdir(parents=True)
        (tmp_path / "d" / f"page_id={i}" / "f").write_bytes(bytes(i + 1))
    staged = []
    original = payloads.stage
    monkeypatch.setattr(payloads, "stage", lambda df, name: staged.append(df.select(F.spark_partition_id()).distinct().count()) or original(df, name))
    files = payloads.listed_files(spark, str(tmp_path / "d"))
    assert sorted(r["bytes"] for r in files.collect()) == list(range(1, 41))
    # the folder named, the folders in it, their files
    assert staged == [1, 1, 4]


def test_round_trip_through_lines(spark, tmp_path):
    write(tmp_path / "h" / "cell_seq=7" / "items.jsonl", {"row_type": "summary", "reported_total": 1}, RECORD, FAILURE)
    first = handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "h")))
    handoff.to_lines(first).write.json(str(tmp_path / "again"))
    again = handoff.split_lines(handoff.read_lines(spark, str(tmp_path / "again")))
    for name in ("items", "totals", "listing_failures"):
        assert [tuple(r) for r in getattr(again, name).collect()] == [tuple(r) for r in getattr(first, name).collect()]


def test_served_type_replaces_the_guess_and_failures_keep_their_row(spark):
    rows = [
        (1, "A B", "text/html", bytearray(b"x"), "application/pdf", "e", "r"),
        (2, "A B", "text/html", bytearray(b"x"), "", None, None),
        (3, "A B", "text/html", None, "application/pdf", "404", "gone"),
    ]
    df = spark.createDataFrame(rows, "item_seq BIGINT, identifier STRING, content_type STRING, payload BINARY, served_content_type STRING, error_code STRING, error_reason STRING")
    named = handoff.payload_name(handoff.captured_rows(df.withColumn("document_url", F.lit("https://s/x.html"))))
    got = [(r["content_type"], r["error_code"], r["payload_name"]) for r in named.orderBy("item_seq").collect()]
    assert got == [("application/pdf", None, "a-b-1.pdf"), ("text/html", None, "a-b-2.html"), ("text/html", "404", "a-b-3.html")]


def test_sources_are_routed_by_name():
    from foliozone.sources.adapter import SiteProfile, SourceRegistry

    registry = SourceRegistry().add(ADAPTER)
    assert registry.names() == ["example_source"] and registry.get("example_source") is ADAPTER
    try:
        registry.get("other")
    except ValueError as error:
        assert "other" in str(error)
    else:
        raise AssertionError("unknown source accepted")
    text = json.dumps({"source_name": "s", "site_root": "https://s", "bodies": [{"code": "a", "name": "A", "external_id": "1"}], "strip_selectors": ["nav"]})
    profile = SiteProfile.from_json(text)
    assert profile.bodies[0].external_id == "1" and profile.strip_selectors == ("nav",) and profile.row_selector == "li.each-item"

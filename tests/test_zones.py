"""Stored rows stay where they are: buckets, point reads, many runs."""

import re
import time

import pytest
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.operators import changes
from foliozone.sources import zones


def plan(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def rows_of(spark, schema, ids, given):
    empty = spark.createDataFrame([], schema)
    return ids.select(*(given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in empty.schema))


def store(zone, first, last):
    """A run that writes the documents first..last - 1."""
    ids, name = zone.spark.range(first, last), F.concat(F.lit("K"), "id")
    day = F.to_date(F.lit("2024-01-15"))
    given = {"identifier": name, "body_code": F.when(F.col("id") % 2 == 0, "a").otherwise("b"), "decision_date": day, "content_fingerprint": F.lit("sha256:1"), "file_path": name, "storage_id": name}
    objects = {"object_key": F.concat(F.lit("s/x/2024-01/"), name), "payload": F.encode(name, "UTF-8"), "kind": F.lit("html"), "period": F.lit("2024-01"), "identifier": name, "body_code": given["body_code"], "decision_date": day}
    zone.append(zone.snapshot(), rows_of(zone.spark, schemas.OBJECTS, ids, objects), rows_of(zone.spark, schemas.METADATA, ids, given))


@pytest.fixture
def zone(spark, tmp_path):
    return zones.Zone(spark, str(tmp_path / "it's a zone"), 4)


@pytest.fixture
def joined(spark):
    """Joins that must shuffle, as those of large tables do."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_rows_take_no_exchange(spark, zone, joined):
    store(zone, 0, 40)
    store(zone, 30, 60)
    current = zone.snapshot().current()
    assert "Exchange hash" not in plan(current) and "Bucketed: true" in plan(current)
    assert {(r["identifier"], r["run_seq"]) for r in current.collect()} == {(f"K{i}", 1 if i < 30 else 2) for i in range(60)}
    items = spark.range(50, 80).select(
        F.lit(0).cast("bigint").alias("cell_seq"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("body_code"), F.concat(F.lit("K"), "id").alias("identifier"),
        F.lit("sha256:1").alias("content_fingerprint"), F.concat(F.lit("K"), "id").alias("file_path"), F.lit(None).cast("string").alias("error_code"),
    )
    decided = changes.detect_changes(items, changes.stored_state(current))
    assert plan(decided).count("Exchange hash") == 1  # the new rows alone, and one for the join and the window after it
    assert {r["identifier"]: r["action"] for r in decided.collect()} == {f"K{i}": "unchanged" if i < 60 else "written" for i in range(50, 80)}


def test_few_keys_read_their_buckets(spark, zone, joined):
    store(zone, 0, 40)
    asked = spark.createDataFrame([("a", "K2"), ("b", "K2"), ("b", None), (None, "K3"), ("b", "K39")], "body_code string, identifier string")
    found = zone.snapshot().find(asked)
    text = plan(found)
    assert re.search(r"SelectedBucketsCount: [123] out of 4", text) and re.search(r"PartitionFilters: \[.*body_code#\d+ IN \(a,b\)", text)
    assert sorted(r["identifier"] for r in found.collect()) == ["K2", "K39"]


def test_many_keys_are_joined(spark, zone, monkeypatch):
    store(zone, 0, 40)
    monkeypatch.setattr(zones, "FEW", 5)
    asked = spark.range(0, 80).select(F.lit("a").alias("body_code"), F.concat(F.lit("K"), "id").alias("identifier"), F.concat(F.lit("s/x/2024-01/K"), "id").alias("object_key"))
    snap = zone.snapshot()
    assert snap.find(asked).count() == 20 and snap.existing(asked.select("object_key")).count() == 40


def rows_read(df):
    """Rows that the scans of a plan gave out."""
    plan_, total = df._jdf.queryExecution().executedPlan(), 0
    df._jdf.queryExecution().toRdd().count()
    leaves = plan_.collectLeaves()
    for i in range(leaves.size()):
        if "FileScan" in leaves.apply(i).simpleString(25):
            total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_point_reads_stay_flat_as_the_zone_grows(spark, zone, joined):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan is the one that runs
    try:
        keys = [f"s/x/2024-01/K{i}" for i in range(5)]
        asked = spark.createDataFrame([(k,) for k in keys], "object_key string")
        wanted = spark.createDataFrame([("a", "K0"), ("b", "K1")], "body_code string, identifier string")
        seen = []
        for run in range(4):
            store(zone, run * 400, run * 400 + 400)
            snap = zone.snapshot()
            assert snap.existing(asked).count() == 5 and snap.find(wanted).count() == 2
            seen.append((rows_read(snap.existing(asked)), rows_read(snap.find(wanted))))
        # later runs hold none of these keys, and their filters say so
        assert len(set(seen)) == 1 and seen[0][0] <= 400, seen
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_twenty_thousand_runs_plan_in_seconds(spark, zone):
    store(zone, 0, 10)
    one = zone.snapshot()
    many = zones.Snapshot(spark, zone.root, (*((n, f"{n:032x}") for n in range(2, 20_002)), *one.names), buckets=one.buckets)
    began = time.monotonic()
    assert many.current().count() == 10
    assert time.monotonic() - began < 30


def test_a_zone_keeps_its_buckets(spark, zone):
    store(zone, 0, 10)
    other = zones.Zone(spark, zone.root, 7)
    store(other, 5, 15)
    assert other.snapshot().buckets == 4 and zone.snapshot().current().count() == 15
    zone.compact()
    zone.vacuum()
    assert other.snapshot().current().count() == 15


def test_staged_tables_go_when_discarded_or_released(spark):
    from pathlib import Path

    from foliozone import session

    place = lambda table: Path(table.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    with session.released(spark):
        first, second, third = (session.stage(spark.range(3), "t", kept) for kept in (False, False, True))
        files = [place(t) for t in (first, second, third)]
        session.discard(first, spark.range(1))
        assert [f.exists() for f in files] == [False, True, True]
    assert [f.exists() for f in files] == [False, False, True] and third.count() == 3
    session.discard(third)
    assert not files[2].exists()

"""The physical plans that matter at scale: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from fixtures import ADAPTER, FEB, JAN
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.operators import audits, changes, repeats
from foliozone.plans import ingest, periods
from foliozone.session import stage
from foliozone.sources import zones


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(text):
    """Input columns of every shuffle in a formatted plan."""
    return re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*)\]$", text, re.M)


@pytest.fixture
def items(spark):
    return stage(spark.createDataFrame([], schemas.CAPTURED), "items")


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(spark, request):
    """Every plan is checked with small sides broadcast and with all joins shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_payload_is_shuffled_to_decide(spark, items, joins, monkeypatch):
    seen = []
    for module in (ingest, repeats, changes):
        original = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, original=original: (seen.append((name, plan(df))), original(df, name))[1])
    cells = periods.plan_cells(spark, ADAPTER, JAN, FEB)
    stored = zones.latest(stage(spark.createDataFrame([], schemas.METADATA), "stored"), changes.KEY)
    ingest.decide(items, cells, stored, ADAPTER)
    assert [name for name, _ in seen] == ["ingest_rows", "repeated_references", "ingest_decided", "collided_keys"]
    for _, text in seen:
        assert not any("payload" in columns.replace("has_payload", "") for columns in exchanges(text))
    readers = [name for name, text in seen if re.search(r"ReadSchema: .*payload:binary", text)]
    assert readers == ["ingest_rows"]
    rows = dict(seen)["ingest_rows"]
    assert rows.count("Scan parquet") == 2  # the node and its detail: one scan


def test_repeat_counting_combines_before_the_shuffle(items, monkeypatch):
    seen = []
    original = repeats.stage
    monkeypatch.setattr(repeats, "stage", lambda df, name: (seen.append(plan(df)), original(df, name))[1])
    repeats.mark_repeats(items)
    before_shuffle = seen[0][seen[0].index("Exchange") :]
    assert "Aggregate" in before_shuffle.split("Scan parquet")[0]
    assert re.search(r"ReadSchema: struct<cell_seq:bigint,item_seq:bigint,identifier:string,body_code:string,document_url:string,error_code:string>", seen[0])


def test_range_scan_prunes_and_pushes_down(spark, tmp_path):
    zone = zones.Zone(spark, str(tmp_path / "z"))
    one = spark.range(1)
    filled = {"body_code": F.lit("first"), "kind": F.lit("html"), "period": F.lit("2024-01"), "run_seq": F.lit(1)}

    def row(schema):
        empty = spark.createDataFrame([], schema)
        values = {f.name: F.lit(None).cast(f.dataType) for f in empty.schema}
        return one.select(*(filled.get(n, c).alias(n) for n, c in values.items()))

    zone.append(zone.snapshot(), row(schemas.OBJECTS), row(schemas.METADATA))
    snap = zone.snapshot()
    text = plan(snap.current(("first",)).select("identifier", "file_path"))
    assert re.search(r"PartitionFilters: \[.*run#.*body_code.*\]", text)
    assert "payload" not in text and "title" not in text
    assert "WindowGroupLimit" in text
    # the date filter stays above the newest version, or an older one would come back
    ranged = plan(zones.range_scan(snap.current(), JAN, FEB))
    assert not re.search(r"PushedFilters: \[.*decision_date", ranged)
    assert re.search(r"PartitionFilters: \[.*period", plan(snap.objects().filter(F.col("period") == "2024-01")))
    assert "payload" not in plan(snap.object_ids())


def test_matching_broadcasts_only_a_counted_set(spark, items, monkeypatch):
    ids = stage(spark.range(10).selectExpr("id cell_seq", "id item_seq"), "ids")
    text = plan(changes.matching(items, ids, ["cell_seq", "item_seq"], F.col("cell_seq") < 3))
    assert "BroadcastHashJoin LeftSemi" in text and not any("payload" in c for c in exchanges(text))
    text = plan(changes.matching(items, ids, ["cell_seq", "item_seq"], F.col("cell_seq") < 8))
    assert "BroadcastHashJoin LeftAnti" in text


def test_windows_need_no_join(spark):
    from foliozone.functions import dates

    df = spark.range(10).select(F.date_add(F.lit(JAN), F.col("id").cast("int")).alias("d"))
    text = plan(df.select(dates.window_of(F.col("d"), F.lit(JAN), F.lit(FEB), "weekly")["label"]))
    assert "Join" not in text and "Exchange" not in text


def test_audits_combine_before_the_shuffle(spark, items):
    text = plan(audits.reference_counts(items))
    assert text.count("HashAggregate") >= 8 and "Expand" not in text

import random

from pyspark.sql import functions as F

from foliozone.operators import audits, changes, repeats

ITEMS = "cell_seq BIGINT, item_seq BIGINT, body_code STRING, identifier STRING, document_url STRING, has_payload BOOLEAN, error_code STRING, error_reason STRING"


def settle(spark, rows):
    df = spark.createDataFrame(rows, ITEMS)
    out = repeats.with_failures(repeats.mark_repeats(df)).collect()
    return {(r["cell_seq"], r["item_seq"]): (r["error_code"], r["error_reason"]) for r in out}


def test_first_row_keeps_the_reference_and_later_ones_name_both_urls(spark):
    got = settle(
        spark,
        [
            (0, 2, "b", "R'1", "u2", True, None, None),
            (0, 1, "b", "R'1", "u1", True, None, None),
            (0, 3, "c", "R'1", "u3", True, None, None),
            (1, 1, "b", "R'1", "u4", True, None, None),
        ],
    )
    assert got[(0, 2)] == (
        "duplicate_case_reference",
        "case reference \"R'1\" is already used in this partition by u1; this row is a different document at u2",
    )
    assert [got[k][0] for k in ((0, 1), (0, 3), (1, 1))] == [None, None, None]


def test_a_failed_first_row_still_owns_its_reference(spark):
    got = settle(
        spark,
        [
            (0, 1, "b", "R", "u1", False, "504", "no answer in time"),
            (0, 2, "b", "R", "u2", True, None, None),
            (0, 3, "b", "S", "u3", False, "", None),
            (0, 4, "b", "T", "u4", True, "504", "late note"),
            (0, 5, "b", "U", "u5", True, "duplicate_case_reference", None),
        ],
    )
    assert got[(0, 1)] == ("504", "no answer in time")
    assert got[(0, 2)][0] == "duplicate_case_reference"
    assert got[(0, 3)] == ("DocumentDownloadError", "document could not be downloaded")
    # an error note beside a payload is not a failure
    assert got[(0, 4)] == (None, None)
    assert got[(0, 5)] == ("duplicate_case_reference", "case reference already seen in this partition")


def test_a_hot_reference_is_rejected_whole(spark):
    n = 3000
    rows = [(0, i, "b", "HOT" if i % 3 else f"k{i}", f"u{i}", True, None, None) for i in range(n)]
    got = settle(spark, rows)
    hot = [i for i in range(n) if i % 3]
    assert len(got) == n and sum(code is not None for code, _ in got.values()) == len(hot) - 1
    assert got[(0, hot[0])][0] is None


CHAIN = "cell_seq BIGINT, body_code STRING, identifier STRING, content_fingerprint STRING, file_path STRING, error_code STRING"
STORED = "body_code STRING, identifier STRING, stored_fingerprint STRING, stored_path STRING"


def test_cells_in_one_pass_equal_a_replay_of_the_loop(spark):
    rng = random.Random(7)
    rows, stored = [], {}
    for key in range(120):
        if rng.random() < 0.6:
            stored[("b", f"k{key}")] = (f"f{rng.randrange(2)}", f"p{rng.randrange(2)}")
        for cell in sorted(rng.sample(range(12), rng.randrange(1, 9))):
            failed = "504" if rng.random() < 0.2 else None
            rows.append((cell, "b", f"k{key}", f"f{rng.randrange(2)}", f"p{rng.randrange(2)}", failed))
    state, expected, last = dict(stored), {}, {}
    for cell, body, key, print_, path, failed in sorted(rows):
        if failed:
            expected[(cell, key)] = "failed"
            continue
        same = state.get((body, key)) == (print_, path)
        expected[(cell, key)] = "unchanged" if same else "written"
        if not same:
            state[(body, key)] = (print_, path)
            last[key] = cell
    decided = changes.detect_changes(
        spark.createDataFrame(rows, CHAIN),
        spark.createDataFrame([(b, k, f, p) for (b, k), (f, p) in stored.items()], STORED),
    ).collect()
    assert {(r["cell_seq"], r["identifier"]): r["action"] for r in decided} == expected
    assert {r["identifier"]: r["cell_seq"] for r in decided if r["keep_metadata"]} == last


def test_change_needs_both_fingerprint_and_path(spark):
    rows = [(0, "b", k, "f", "p", None) for k in "abcd"]
    stored = [("b", "a", "f", "p"), ("b", "b", "x", "p"), ("b", "c", "f", "q")]
    got = changes.detect_changes(spark.createDataFrame(rows, CHAIN), spark.createDataFrame(stored, STORED)).collect()
    assert {r["identifier"]: r["action"] for r in got} == {"a": "unchanged", "b": "written", "c": "written", "d": "written"}


def test_records_without_a_fingerprint_compare_by_hash(spark):
    meta = spark.createDataFrame([("b", "a", None, "sha256:1", "p"), ("b", "c", "", "none", "p")], "body_code STRING, identifier STRING, content_fingerprint STRING, file_hash STRING, file_path STRING")
    got = {r["identifier"]: r["stored_fingerprint"] for r in changes.stored_state(meta).collect()}
    assert got == {"a": "sha256:1", "c": None}


def test_last_write_to_a_key_wins(spark):
    rows = [(0, 1, "p", "written"), (1, 0, "p", "written"), (1, 5, "p", "unchanged"), (0, 9, "q", "written")]
    df = spark.createDataFrame(rows, "cell_seq BIGINT, item_seq BIGINT, file_path STRING, action STRING")
    kept = changes.keep_last_object(df, ["cell_seq", "item_seq"]).filter("keep_object").collect()
    assert sorted((r["cell_seq"], r["item_seq"]) for r in kept) == [(0, 9), (1, 0)]


def test_keys_seen_twice_are_kept_with_their_nulls(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, None), (2, None), (None, None), (3, "a")]
    found = changes.seen_twice(spark.createDataFrame(rows, "k INT, v STRING"), ["k", "v"]).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "a"), (1, "a"), (None, "c"), (None, "c"), (2, None), (2, None)], key=str)


def test_matching_is_exact_whichever_set_travels(spark, monkeypatch):
    wide = spark.range(100).selectExpr("id", "repeat('x', 10) payload")
    for bound in (1_000_000, 0):
        monkeypatch.setattr(changes, "BROADCAST_BYTES", bound)
        for few in (3, 97):
            ids = spark.range(100).withColumn("k", F.col("id") < few)
            got = changes.matching(wide, ids, ["id"], F.col("k"))
            assert sorted(r["id"] for r in got.collect()) == list(range(few))


def test_audits(spark):
    records = spark.createDataFrame(
        [("2024-01-05", "2024-01", "b", "R", "u1"), ("2024-01-09", "2024-01", "b", "R", "u2"), ("2024-01-09", "2024-02", "b", "S", "u3")],
        "decision_date STRING, partition_date STRING, body_code STRING, identifier STRING, document_url STRING",
    ).withColumn("decision_date", F.col("decision_date").cast("date"))
    (row,) = audits.reference_counts(records).collect()
    assert tuple(row) == ("2024-01", "b", 3, 2, 1)
    assert sorted(r["document_url"] for r in audits.repeated_references(records).collect()) == ["u1", "u2"]

"""What has to be written: fingerprints compared with the stored state, cell after cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliozone.functions import hashing, keys
from foliozone.session import stage

KEY = ["body_code", "identifier"]
# An id set is broadcast up to so many bytes of its own columns.
BROADCAST_BYTES = 128 << 20
# So many hashes of keys are broadcast, 8 bytes each.
FEW_HASHES = 1 << 20
WRITTEN, UNCHANGED, FAILED = "written", "unchanged", "failed"


def stored_state(metadata: DataFrame) -> DataFrame:
    """The part of the current metadata that the change check reads."""
    return metadata.select(
        *KEY,
        hashing.comparison_fingerprint(F.col("content_fingerprint"), F.col("file_hash")).alias("stored_fingerprint"),
        F.col("file_path").alias("stored_path"),
    )


def detect_changes(items: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``action``, and ``keep_metadata`` on the row whose write is the last of its key.

    ``items`` carry ``cell_seq, body_code, identifier, content_fingerprint, file_path, error_code``.
    Cells run in order, so a row is compared with what the previous cell of the same key left
    behind, and only the first with the stored state. An unchanged row leaves exactly its own
    fingerprint and path, so looking back one row is enough.

    Live rows of a key number at most one per cell, which bounds their window group. Rows that
    already failed bypass the shuffle, so a reference repeated any number of times does not pile
    up. ``items`` is read twice for that: pass narrow rows of a staged table, never payloads.
    """
    by_key = Window.partitionBy(*KEY)
    in_order = by_key.orderBy("cell_seq")
    before_print = F.lag("content_fingerprint").over(in_order)
    before_path = F.lag("file_path").over(in_order)
    is_first = F.row_number().over(in_order) == 1
    same = F.when(
        is_first,
        (F.col("content_fingerprint") == F.col("stored_fingerprint")) & (F.col("file_path") == F.col("stored_path")),
    ).otherwise((F.col("content_fingerprint") == before_print) & (F.col("file_path") == before_path))
    last_write = F.max(F.when(F.col("action") == WRITTEN, F.col("cell_seq"))).over(by_key)
    live = (
        items.filter("error_code IS NULL")
        .join(stored, KEY, "left")
        .withColumn("action", F.when(F.coalesce(same, F.lit(False)), UNCHANGED).otherwise(WRITTEN))
        .withColumn("last_write", last_write)
        .withColumn("keep_metadata", (F.col("action") == WRITTEN) & (F.col("cell_seq") == F.col("last_write")))
        .drop("last_write", "stored_fingerprint", "stored_path")
    )
    failed = items.filter("error_code IS NOT NULL").withColumns(
        {"action": F.lit(FAILED), "keep_metadata": F.lit(False)}
    )
    return live.unionByName(failed)


def seen_twice(rows: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is there more than once, and a few whose key shares its hash with another.

    Counting 64-bit hashes sorts nothing and moves no key, and most keys are there once. Up to
    ``FEW_HASHES`` of those that are there more often are broadcast. ``rows`` is read three times:
    pass narrow rows of a staged table. Nulls are equal here.
    """
    hashed = rows.withColumn("_key_hash", F.xxhash64(*on))
    often = hashed.groupBy("_key_hash").agg(F.count("*").alias("n")).filter("n > 1").select("_key_hash")
    few = often.count() <= FEW_HASHES
    return hashed.join(F.broadcast(often) if few else often, "_key_hash", "left_semi").drop("_key_hash")


def keep_last_object(decided: DataFrame, order: list[str]) -> DataFrame:
    """Add ``keep_object``: of several writes to one object key only the last one survives.

    Written keys are counted first, by their hashes, and only the collided ones are staged and
    joined back, so a file name shared by a large share of a cell costs one row per key, not one
    group in one task. ``decided`` is read four times, so pass a staged table.
    """
    place = F.struct(*order)
    collided = stage(
        seen_twice(decided.filter(F.col("action") == WRITTEN), ["file_path"])
        .groupBy("file_path")
        .agg(F.count("*").alias("n"), F.max(place).alias("last_place"))
        .filter("n > 1")
        .drop("n"),
        "collided_keys",
    )
    survives = F.col("last_place").isNull() | (place == F.col("last_place"))
    return (
        decided.join(collided, "file_path", "left")
        .withColumn("keep_object", (F.col("action") == WRITTEN) & survives)
        .drop("last_place")
    )


def stamp(rows: DataFrame, run_ts: Column) -> DataFrame:
    """Storage columns of the rows about to be persisted; one clock value for the whole run."""
    version = {} if "landing_version" in rows.columns else {"landing_version": F.lit(None).cast("string")}
    return rows.withColumns(
        version
        | {
            "storage_id": keys.storage_id(F.col("body_code"), F.col("identifier")),
            "scraped_at": run_ts,
        }
    )


def matching(wide: DataFrame, ids: DataFrame, on: list[str], keep: Column) -> DataFrame:
    """Rows of a wide table whose id is marked in ``ids``, which lists every id of the table.

    Payloads should not be shuffled, so the smaller of the two sets is the one that travels: the
    kept ids as a semi join, or the others as an anti join. Either is exact. The set is staged
    and measured; up to ``BROADCAST_BYTES`` it is broadcast, beyond that the join shuffles.
    ``ids`` is read twice, so pass a staged table.
    """
    flagged = ids.select(*on, keep.alias("keep"))
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in on), F.lit(0))
    kept, kept_bytes, total, all_bytes = flagged.agg(
        F.count_if("keep"), F.sum(F.when(F.col("keep"), width)), F.count("*"), F.sum(width)
    ).first()
    kept_bytes, all_bytes = kept_bytes or 0, all_bytes or 0
    few_kept = kept * 2 <= total
    travelling = stage(flagged.filter(F.col("keep") == few_kept).select(*on), "ids")
    if (kept_bytes if few_kept else all_bytes - kept_bytes) <= BROADCAST_BYTES:
        travelling = F.broadcast(travelling)
    return wide.join(travelling, on, "left_semi" if few_kept else "left_anti")

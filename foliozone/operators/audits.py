"""Reports over stored tables: repeated references, collisions, drift, yield, churn."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliozone.operators.changes import WRITTEN
from foliozone.sources import markup


def reference_counts(records: DataFrame) -> DataFrame:
    """Rows against distinct references per month of decision and body.

    Two sums over pre-aggregated keys instead of a distinct aggregate: both levels combine on
    the map side, so a body or a reference with a third of all rows stays cheap.
    """
    per_key = records.groupBy(
        F.date_format("decision_date", "yyyy-MM").alias("month"), "body_code", "identifier"
    ).agg(F.count("*").alias("n"))
    return per_key.groupBy("month", "body_code").agg(
        F.sum("n").alias("row_count"),
        F.count("*").alias("distinct_references"),
        F.count_if(F.col("n") > 1).alias("repeated_references"),
    )


def repeated_references(records: DataFrame) -> DataFrame:
    """Every row whose reference is used again in the same month and body, one url per row.

    Long form on purpose: a list per reference would gather an unbounded group in one cell.
    """
    month = records.withColumn("month", F.date_format("decision_date", "yyyy-MM"))
    keys = ["month", "body_code", "identifier"]
    repeated = month.groupBy(*keys).agg(F.count("*").alias("uses")).filter("uses > 1")
    return month.join(repeated, keys).select(*keys, "uses", "document_url")


def keys_in_several_cells(records: DataFrame) -> DataFrame:
    """References present under several labels: each run rewrites them once per label."""
    per_label = records.groupBy("body_code", "identifier", "partition_date").agg(F.count("*").alias("n"))
    return (
        per_label.groupBy("body_code", "identifier")
        .agg(F.count("*").alias("labels"), F.sum("n").alias("row_count"))
        .filter("labels > 1")
    )


def key_collisions(records: DataFrame) -> DataFrame:
    """Object keys that several stored identifiers would overwrite in turn."""
    per_identifier = records.groupBy("file_path", "body_code", "identifier").agg(F.count("*").alias("n"))
    return (
        per_identifier.groupBy("file_path")
        .agg(F.count("*").alias("identifiers"), F.min("identifier").alias("first_identifier"))
        .filter("identifiers > 1")
    )


def catalogue_drift(catalogue: DataFrame, observed: DataFrame) -> DataFrame:
    """``(external_id, name)`` known against seen: added, removed, renamed or same."""
    known = catalogue.select("external_id", F.col("name").alias("known_name"), F.lit(True).alias("k"))
    seen = observed.select("external_id", F.col("name").alias("seen_name"), F.lit(True).alias("s"))
    status = (
        F.when(F.col("k").isNull(), "added")
        .when(F.col("s").isNull(), "removed")
        .when(F.col("known_name") != F.col("seen_name"), "renamed")
        .otherwise("same")
    )
    return known.join(seen, "external_id", "full_outer").select(
        "external_id", "known_name", "seen_name", status.alias("status")
    )


def observed_bodies(pages: DataFrame, profile) -> DataFrame:
    """Read the ``(external_id, name)`` pairs a captured search page offers in its body filter.

    ``found`` is false where the page has no such filter, so changed markup is not mistaken for
    an empty catalogue.
    """
    label = profile.body_filter_label

    def read(batches):
        inputs = markup.compile_selector("input[type=checkbox][value]")

        def tidy(node):
            return " ".join(node.text(" ").split())

        for batch in batches:
            rows = []
            for payload in batch.column(0).to_pylist():
                page = markup.parse(payload)
                labels = [n for n in page.walk() if n.name == "label" and n.attrs.get("for")]
                target = next((n.attrs["for"] for n in labels if tidy(n) == label), None)
                group = next((n for n in page.walk() if n.name == "span" and n.attrs.get("id") == target), None)
                if target is None or group is None:
                    rows.append((None, None, False))
                    continue
                names = {n.attrs.get("for"): tidy(n) for n in group.walk() if n.name == "label"}
                for box in markup.select(group, inputs):
                    rows.append((box.attrs["value"], names.get(box.attrs.get("id"), ""), True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.bool_()),
                ],
                names=["external_id", "name", "found"],
            )

    return pages.select("payload").mapInArrow(read, "external_id STRING, name STRING, found BOOLEAN")


def extraction_yield(raw: DataFrame, curated: DataFrame) -> DataFrame:
    """Bytes before and after cleaning. Payloads are measured at the scan, only sums travel."""

    def size(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count("payload").alias(f"{name}_documents"),
            F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("bigint").alias(f"{name}_bytes"),
        ).withColumn("one", F.lit(1))

    return size(raw, "raw").join(size(curated, "curated"), "one").drop("one")


def rerun_churn(decided: DataFrame, flag: str) -> DataFrame:
    """Share of handled documents that a re-run rewrote."""
    written = F.count_if(F.col("action") == WRITTEN)
    return decided.filter("error_code IS NULL").agg(
        F.lit(flag).alias("compared_by"), F.count("*").alias("documents"), written.alias("rewritten")
    )

"""Captured rows in line-delimited JSON: the exchange with a fetcher outside Spark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.functions import keys, text
from foliozone.sources.payloads import FilePayloads, Payloads, listed_files, opened_files

# The three kinds of row.
RECORD, SUMMARY, LISTING_FAILURE = "record", "summary", "listing_failure"

BAD_LINE = "handoff_line_unreadable"
BAD_LINE_REASON = "not a JSON object: "


@dataclass(frozen=True)
class Capture:
    """Everything a fetch brought home, for all cells of a run at once.

    Items hold their ``payload``, or the ``payload_ref`` of one that lies in ``payloads``. ``rejects``
    are listing entries that were set aside; a run logs them.
    """

    items: DataFrame
    totals: DataFrame
    listing_failures: DataFrame
    dead_cells: DataFrame
    payloads: Payloads | None = None
    rejects: DataFrame | None = None

    @classmethod
    def of(cls, spark: SparkSession, items: DataFrame, totals=None, listing_failures=None, dead_cells=None, payloads=None, rejects=None) -> "Capture":
        def given(df, schema):
            return df if df is not None else spark.createDataFrame([], schema)

        return cls(
            items,
            given(totals, schemas.TOTALS),
            given(listing_failures, schemas.LISTING_FAILURES),
            given(dead_cells, schemas.DEAD_CELLS),
            payloads,
            rejects,
        )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Hand-off rows with their position. Blank lines are skipped; a missing path is an empty table.

    A line that is no JSON object becomes a listing failure of its folder's cell, or of no cell,
    so that no run with such a line reconciles. A row of any other type than summary and listing
    failure, or of none, is a record.

    Cells come from the rows, or from ``cell_seq=N`` directories. ``line_order`` sorts the lines
    of one file as written: split offset, then order inside the split. Rows that carry no
    ``item_seq`` get one from it: the offset plus the line's ordinal in its task, which grows
    along a file because a split of n bytes holds at most n lines.
    """
    from pyspark.errors import AnalysisException

    columns = [f.strip().split() for f in schemas.HANDOFF.split(",")]
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schemas.HANDOFF)
        return empty.withColumn("line_order", F.lit(None).cast("struct<split:bigint,line:bigint>"))
    folder_cell = F.col("cell_seq").cast("bigint") if "cell_seq" in lines.columns else F.lit(None).cast("bigint")
    ordinal = F.col("line_order.line").bitwiseAND(F.lit((1 << 33) - 1))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull()
    given = lambda name: F.when(~bad, F.col(f"row.{name}"))
    kind = F.when(bad, LISTING_FAILURE).when(F.col("row.row_type").isin(SUMMARY, LISTING_FAILURE), F.col("row.row_type"))
    filled = {
        "row_type": F.coalesce(kind, F.lit(RECORD)),
        "error_code": F.when(bad, BAD_LINE).otherwise(F.col("row.error_code")),
        "error_reason": F.when(bad, F.concat(F.lit(BAD_LINE_REASON), F.substring("value", 1, 200))).otherwise(F.col("row.error_reason")),
        "cell_seq": F.coalesce(given("cell_seq"), "folder_cell"),
        "item_seq": F.coalesce(given("item_seq"), F.col("line_order.split") + ordinal),
    }
    return (
        lines.select(
            F.from_json("value", f"{schemas.HANDOFF}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}).alias("row"),
            folder_cell.alias("folder_cell"),
            F.struct(
                F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line")
            ).alias("line_order"),
            "value",
            (text.strip(F.col("value")) == "").alias("blank"),
        )
        .filter("NOT blank")
        .select(*(filled.get(name, given(name)).alias(name) for name, _ in columns), "line_order")
    )


def split_lines(lines: DataFrame, payloads: DataFrame | None = None) -> Capture:
    """Route rows by type, take each cell's last reported total.

    ``payloads`` is ``(path, content)`` as the ``binaryFile`` source gives it. The rows keep the
    path alone as ``payload_ref``, so no bytes are moved here; those without a path, or without
    ``payloads``, have no payload and the error that explains it.
    """
    spark = lines.sparkSession
    path = keys.path_only(F.nullif(F.col("local_path"), F.lit("")))
    payload = [F.lit(None).cast("binary").alias("payload")] if payloads is None else [path.alias("payload_ref"), F.col("byte_count")]
    records = lines.filter(F.col("row_type") == RECORD).select(
        "cell_seq",
        "item_seq",
        *(F.col(c).cast("date") if c == "decision_date" else F.col(c) for c in schemas.RECORD_COLUMNS),
        *payload,
        "error_code",
        "error_reason",
    )
    return Capture.of(
        spark,
        records,
        lines.filter(F.col("row_type") == SUMMARY)
        .groupBy("cell_seq")
        .agg(F.max_by("reported_total", "line_order").alias("reported_total"))
        .filter("reported_total IS NOT NULL"),
        lines.filter(F.col("row_type") == LISTING_FAILURE).select(
            "cell_seq", "page_number", "url", "error_code", "error_reason"
        ),
        payloads=None if payloads is None else FilePayloads(payloads),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every file below a folder: listed now, opened by the tasks that work on them."""
    return opened_files(listed_files(spark, path))


def to_lines(capture: Capture) -> DataFrame:
    """The reverse mapping: a capture as hand-off rows, one table with the superset schema."""
    wanted = [f.strip().split() for f in schemas.HANDOFF.split(",")]

    def shaped(df: DataFrame, kind: str) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *(
                F.lit(kind).alias("row_type")
                if name == "row_type"
                else (F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in wanted
            )
        )

    return (
        shaped(_with_path(capture.items), RECORD)
        .unionByName(shaped(capture.totals, SUMMARY))
        .unionByName(shaped(capture.listing_failures, LISTING_FAILURE))
    )


def _with_path(items: DataFrame) -> DataFrame:
    """Rows that refer to files keep the path; no other payload can be written as a line."""
    if dict(items.dtypes).get("payload_ref") == "string":
        return items.drop("local_path").withColumnRenamed("payload_ref", "local_path")
    return items.drop("payload", "payload_ref")


def captured_rows(records: DataFrame, held: str = "payload") -> DataFrame:
    """Shape fetched documents as captured items.

    A served content type replaces the guess when it is not empty; a failed fetch keeps its row,
    with a null payload (or ref, whichever is ``held``) and its error.
    """
    arrived = F.col(held).isNotNull()
    return records.withColumns(
        {
            "content_type": F.when(
                arrived, keys.served_content_type(F.col("served_content_type"), F.col("content_type"))
            ).otherwise(F.col("content_type")),
            "error_code": F.when(~arrived, F.col("error_code")),
            "error_reason": F.when(~arrived, F.col("error_reason")),
        }
    ).drop("served_content_type")


def payload_name(records: DataFrame) -> DataFrame:
    """Add the file name a fetcher should store each payload under."""
    return records.withColumn(
        "payload_name",
        keys.handoff_filename(
            text.slugify_identifier(F.col("identifier")),
            F.col("item_seq"),
            keys.extension_for(F.col("content_type"), F.col("document_url")),
        ),
    )

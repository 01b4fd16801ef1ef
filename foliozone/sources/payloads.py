"""Payload bytes that lie apart from the rows that refer to them, read twice and moved never.

The first reading takes sizes and hashes in one pass over the bytes, without a shuffle; rows join
these narrow prints by ``payload_ref``, and everything is decided on them. The second reading opens
only what is to be written, for rows that are already dealt to the task that writes them.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING, Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliozone.functions import hashing, keys
from foliozone.session import places, stage

if TYPE_CHECKING:
    from foliozone.sources.adapter import SourceAdapter

#: Bytes that one task reads and writes, and what opening a file counts as.
TASK_BYTES, OPENING = 128 << 20, 64 << 10
#: Rows of a directory that are put in order together to be dealt out.
GROUP_ROWS = 100_000
#: Bytes of files in one batch.
BATCH_BYTES = 32 << 20
#: Narrow rows are broadcast up to so many bytes.
BROADCAST_BYTES = 128 << 20
#: Tasks that list folders at least, if there are so many, and folders that one task lists at most.
LISTING_TASKS, LISTED_FOLDERS = 32, 256


class Payloads(Protocol):
    def prints(self, adapter: SourceAdapter, rows: DataFrame) -> DataFrame:
        """``payload_ref, payload_bytes, file_hash, html_hash`` of every payload that is there, one row each."""

    def attach(self, rows: DataFrame, folders: list[str]) -> tuple[DataFrame, bool]:
        """``rows`` (with ``payload_ref, payload_bytes``) with their ``payload``; whether they are dealt by ``folders``."""


def prints_of(payload: Column, adapter: SourceAdapter) -> list[Column]:
    """Size, hash, and hash of the bytes as they are compared if they turn out to be HTML.

    The content type is a matter of the row, not of the bytes; only whether it is HTML changes
    what is compared.
    """
    return [
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        hashing.content_hash(payload).alias("file_hash"),
        hashing.content_hash(adapter.normalise(payload, F.lit("text/html"))).alias("html_hash"),
    ]


def deal_by_bytes(rows: DataFrame, folders: list[str], size: Column, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The same rows in partitions of about ``task_bytes`` that hold whole stretches of few folders.

    All rows are laid on one line, folder by folder, each as long as its bytes; a partition is a
    piece of the line. So a folder of any size is dealt to as many tasks as its bytes need, and
    small folders share one. Only groups of at most about ``GROUP_ROWS`` rows are ordered together.
    ``rows`` are narrow, and read three times: pass a staged table.
    """
    total, count = rows.agg(F.coalesce(F.sum(size + F.lit(OPENING)), F.lit(0)), F.count("*")).first()
    if not count:
        return rows
    parts = count // GROUP_ROWS + 1
    spread = rows.withColumn("_length", size + F.lit(OPENING)).withColumn("_part", F.pmod(F.xxhash64("payload_ref"), F.lit(parts)))
    group = [*folders, "_part"]
    groups = spread.groupBy(*group).agg(F.sum("_length").alias("_group"))
    # one row a folder and part: a few for each month and body
    ahead = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.withColumn("_start", F.coalesce(F.sum("_group").over(ahead), F.lit(0))).drop("_group")
    starts = starts.select(*(F.col(c).alias(f"_{c}") for c in group), "_start")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    within = Window.partitionBy(*group).orderBy("payload_ref").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_length").over(within), F.lit(0))
    placed = spread.join(starts, on).drop(*(f"_{c}" for c in group)).withColumn("_task", F.floor((F.col("_start") + before) / task_bytes).cast("int"))
    return placed.repartitionById(int(total // task_bytes) + 1, F.col("_task")).drop("_length", "_part", "_start", "_task")


# --- files named by path


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """Spark's names of S3 stores are one scheme here; a relative path is one of the local disk."""
    path = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:(//)?", "", path))
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def _size(path: str) -> int | None:
    files, inside = _place(path)
    return files.get_file_info(inside).size


def _bytes(path: str) -> bytes:
    files, inside = _place(path)
    with files.open_input_stream(inside, compression=None) as stream:
        return stream.read()


def write_folder(path: str) -> None:
    files, inside = _place(path)
    files.create_dir(inside)


def write_file(path: str, parts: Iterable[bytes]) -> None:
    """Write a file into a folder that is there, under a hidden name until it is whole."""
    files, inside = _place(path)
    folder, name = inside.rsplit("/", 1)
    made = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(made, compression=None) as stream:
        for part in parts:
            stream.write(part)
    files.move(made, inside)


def _empty_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = [p for p in batch.column(0).to_pylist() if _size(p) == 0]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["payload_ref"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the bytes of their files, in batches of about ``BATCH_BYTES``."""
    for batch in batches:
        names, at = [*batch.schema.names, "payload"], batch.schema.names.index("payload_ref")
        held, size, first = [], 0, 0
        for i, path in enumerate(batch.column(at).to_pylist()):
            held.append(_bytes(path))
            size += len(held[-1])
            if size >= BATCH_BYTES or i + 1 == len(batch):
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(held)).columns, pa.array(held, pa.binary())], names=names)
                held, size, first = [], 0, i + 1


def _shown(name: str) -> bool:
    """Whether Spark's file sources show a file or folder of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return True
    return not (name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name))


_LISTED = "path STRING, bytes BIGINT, is_folder BOOLEAN"


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each of the folders."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            files, inside = _place(folder)
            held = [i for i in files.get_file_info(fs.FileSelector(inside)) if _shown(i.base_name) and i.type in (fs.FileType.File, fs.FileType.Directory)]
            paths = pa.array([f"{folder.rstrip('/')}/{i.base_name}" for i in held], pa.string())
            sizes = pa.array([i.size or 0 for i in held], pa.int64())
            folders = pa.array([i.type == fs.FileType.Directory for i in held], pa.bool_())
            yield pa.RecordBatch.from_arrays([paths, sizes, folders], names=["path", "bytes", "is_folder"])


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes`` of every file below a folder, level by level, each folder by one of many tasks.

    The driver never holds the list. Hidden files and files of no bytes are left out, as file sources do.
    """
    named = places(spark, path)
    if not named:
        spark.read.format("binaryFile").load(path)  # raises Spark's own error
    found = level = stage(spark.createDataFrame(named, _LISTED), "listed_files")
    while count := level.filter("is_folder").count():
        folders = level.filter("is_folder").select("path").repartition(min(count, LISTING_TASKS + count // LISTED_FOLDERS))
        level = stage(folders.mapInArrow(_contents, _LISTED), "listed_files")
        found = found.unionByName(level)
    return found.filter("NOT is_folder AND bytes > 0").select("path", "bytes")


def opened_files(files: DataFrame) -> DataFrame:
    """``path, content`` of listed files, as the ``binaryFile`` source gives it, dealt to tasks by bytes.

    That source would give every 32 small files a task of their own.
    """
    named = files.select(keys.path_only(F.col("path")).alias("payload_ref"), "path", "bytes")
    dealt = deal_by_bytes(named, [], F.col("bytes"))
    opened = dealt.mapInArrow(_opened, "payload_ref STRING, path STRING, bytes BIGINT, payload BINARY")
    return opened.select("path", F.col("payload").alias("content"))


@dataclass(frozen=True)
class FilePayloads:
    """One file a payload, named by its path; ``files`` is ``(path, content)`` as the ``binaryFile`` source gives it."""

    files: DataFrame

    def prints(self, adapter: SourceAdapter, rows: DataFrame) -> DataFrame:
        """File sources skip empty files, and an empty payload is a success where a missing one is not.

        So paths that were not listed are looked up, unless their rows carry a ``byte_count``.
        """
        listed = stage(self.files.select(keys.path_only(F.col("path")).alias("payload_ref"), *prints_of(F.col("content"), adapter)), "payload_prints")
        asked = rows.filter("payload_ref IS NOT NULL").select("payload_ref", "byte_count")
        unknown = asked.filter("byte_count IS NULL").select("payload_ref").distinct().join(listed, "payload_ref", "left_anti")
        empty = asked.filter("byte_count = 0").select("payload_ref").unionByName(unknown.mapInArrow(_empty_ones, "payload_ref STRING"))
        empty = empty.distinct().join(listed, "payload_ref", "left_anti")
        return listed.unionByName(empty.select("payload_ref", *prints_of(F.lit(b""), adapter)))

    def attach(self, rows: DataFrame, folders: list[str]) -> tuple[DataFrame, bool]:
        dealt = deal_by_bytes(stage(rows, "wanted_payloads"), folders, F.col("payload_bytes"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        return dealt.mapInArrow(_opened, f"{fields}, payload BINARY"), True


# --- rows of a table


@dataclass(frozen=True)
class RowPayloads:
    """Fetched documents as rows ``cell_seq, document_url, payload``; equal bytes of a url count once.

    ``seen``: the prints, with ``payload_ref`` as (cell, url) of the row that holds the bytes.
    """

    documents: DataFrame
    seen: DataFrame

    def prints(self, adapter: SourceAdapter, rows: DataFrame) -> DataFrame:
        return self.seen.select("payload_ref", "payload_bytes", "file_hash", "html_hash")

    def attach(self, rows: DataFrame, folders: list[str]) -> tuple[DataFrame, bool]:
        """The narrow rows travel to the payloads; beyond ``BROADCAST_BYTES`` of them both are shuffled."""
        wanted = stage(rows.withColumns({"_cell": F.col("payload_ref.cell_seq"), "_url": F.col("payload_ref.document_url")}), "wanted_payloads")
        width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in wanted.columns), F.lit(0))
        if (wanted.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        held = self.documents.select(F.col("cell_seq").alias("_cell"), F.col("document_url").alias("_url"), "payload")
        return held.join(wanted, ["_cell", "_url"]).drop("_cell", "_url"), False

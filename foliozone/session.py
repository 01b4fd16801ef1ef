"""Session settings and staged tables."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Payload rows are large: small batches to the Python workers, small splits per task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Plans name all their filters, however long the numbers of columns have become.
    "spark.sql.maxMetadataStringLength": "1000",
}

#: Rows that Python gets and hands back at once, and bytes of their payloads that it holds at once.
BATCH_ROWS, BATCH_BYTES = int(SETTINGS["spark.sql.execution.arrow.maxRecordsPerBatch"]), 8 << 20

# AQE joins small shuffle partitions but splits only skewed ones, so a cluster starts with many.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "foliozone", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cluster = {} if master and master.startswith("local") else CLUSTER_SETTINGS
    for key, value in {**SETTINGS, **cluster, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of payload rows in a session that was not built here; the default is 10,000 rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= 2 * BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``BATCH_ROWS`` and about ``BATCH_BYTES`` of a binary column at a time."""
    for batch in batches:
        first = held = 0
        for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if i > first and (i - first >= BATCH_ROWS or held + (size or 0) > BATCH_BYTES):
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size or 0
        if first < len(batch):
            yield batch.slice(first)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one made for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(_application: str) -> str:
    return tempfile.mkdtemp(prefix="foliozone-")


def stage(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, makes costly steps run once, and keeps
    column pruning, which ``checkpoint()`` would lose. ``kept``: ``released`` leaves it alone.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stage/{uuid.uuid4().hex}"
    if not kept:
        _staged.append(folder)
    df.write.parquet(f"{folder}/{name}")
    table = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    _folders[table] = folder
    return table


_staged: list[str] = []
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Remove tables as ``stage`` gave them, once nothing that is still to be computed reads them."""
    for table in tables:
        folder = _folders.pop(table, None)
        if folder in _staged:
            _staged.remove(folder)
        if folder:
            remove(table.sparkSession, folder)


@contextmanager
def released(spark: SparkSession):
    """Removes the tables staged inside the block when it ends, however it ends.

    What is to be read afterwards has to be written elsewhere first.
    """
    mark = len(_staged)
    try:
        yield
    finally:
        mine, _staged[mark:] = _staged[mark:], []
        for folder in mine:
            remove(spark, folder)


def _store(spark: SparkSession, path: str):
    """The session's own file system for a path, whatever its scheme, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def remove(spark: SparkSession, path: str) -> None:
    files, place = _store(spark, path)
    files.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> str:
    """A folder that is there from now on, by its full name."""
    files, place = _store(spark, path)
    files.mkdirs(place)
    return files.getFileStatus(place).getPath().toString()


def places(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """What a path or pattern names: full names, sizes, and whether they are folders."""
    files, place = _store(spark, path)
    return [(s.getPath().toString(), s.getLen(), s.isDirectory()) for s in files.globStatus(place) or ()]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is not there yet; False if it is there, also if another was faster."""
    from py4j.protocol import Py4JJavaError

    files, place = _store(spark, path)
    if files.exists(place):
        return False
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if files.exists(place):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True

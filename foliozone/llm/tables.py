"""Reading the corpus tables, row keys and batch sizes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in a batch for Python; texts of a batch are in memory together.
BATCH_ROWS = 500
#: Bits of a table of names: 16 for each, between these (512 KB and 32 MB).
LEAST_SLOTS, MOST_SLOTS = 1 << 22, 1 << 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: hand Python fewer rows at a time than the default of 10,000."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_key(text: str | Column = "text") -> Column:
    """With doc_id, the key of a row's text: repeated rows share it, as they share every result."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns of two tables."""
    on = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        on = on & left[name].eqNullSafe(right[name])
    return on


def wrapped(docs: DataFrame) -> DataFrame:
    """doc (the whole row), doc_id, text and text_key: names that meet no others; ``doc.*`` unwraps."""
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("doc")
    return docs.select(row, "doc_id", "text", text_key().alias("text_key"))


@dataclass
class Table:
    """Bits of a set of 64-bit names."""

    bits: bytes
    shift: int

    def check(self):
        """A function that tells which names may be among them; a no is sure."""
        known = np.unpackbits(np.frombuffer(self.bits, dtype=np.uint8), bitorder="little").astype(bool)
        return lambda names: known[(names >> np.uint64(self.shift)).astype(np.int64)]


def bit_table(names: DataFrame) -> Table:
    """Of the column ``name``; what the driver gets is the table itself, MOST_SLOTS bits at most."""
    wanted = 16 * names.count()
    slots = min(max(LEAST_SLOTS, 1 << (wanted - 1).bit_length()), MOST_SLOTS)
    shift = 64 - (slots.bit_length() - 1)
    slot = F.shiftrightunsigned("name", shift) + 1
    rows = names.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    size = 4096  # bytes of a bucket
    bits = bytearray(max(slots // 8, size))
    for bucket, part in rows:
        bits[(bucket - 1) * size : bucket * size] = part
    return Table(bytes(bits), shift)

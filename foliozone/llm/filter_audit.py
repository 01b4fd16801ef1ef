"""Interaction of five text filters: what each removes in every order, from one count of fail patterns.

Spark reads every text once, as five fail bits, and counts documents by part (their lang) and bits: a
tensor of 2 x 2 x 2 x 2 x 2 counts a part, one for all documents, one for good and one for toxic
ones. Every figure of every order is a contraction of such a tensor with a vector along each axis:
``passes``, ``fails`` or ``either``. A step's filter takes ``fails`` (removed) or ``passes`` (kept),
the filters before it ``passes``, those after it ``either``.

Filters fail a document as follows. A: few words. B: few distinct words. C: many capitals. D: a symbol.
E: the text of a smaller doc_id, anywhere in the table.

A null text is empty, a null lang the part ``""``, together with an empty one. A null doc_id is
neither smaller nor larger than another, so its row never fails E, and has no labels. Repeated rows
count as documents of their own; rows of one doc_id don't fail each other in E. A document is good
(toxic) if any of its label rows says so. An empty table has no part and gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType

from foliozone.llm.tables import small_batches
from foliozone.session import stage

FILTERS = "ABCDE"
#: A: fewer words fail. B: a smaller percentage of distinct words fails. C: a larger one of capitals fails.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: D: these characters.
SYMBOLS = b"#$%&*|"

CAPITALS = bytes(range(0x41, 0x5B))
#: Bytes of a code point after its first.
FOLLOWING = bytes(range(0x80, 0xC0))

FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{name} bigint" for name in FIGURES)


def own_fails(text: bytes) -> int:
    """Bits of A (1) to D (8), which a text decides alone."""
    words = text.split()  # of bytes: at ASCII white space only
    points = len(text.translate(None, FOLLOWING))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (len(text.translate(None, SYMBOLS)) != len(text)) << 3
    )


@arrow_udf(IntegerType())
def _fails(texts: pa.Array) -> pa.Array:
    return pa.array([own_fails((t.as_py() or "").encode()) for t in texts], pa.int32())


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, fails, good, toxic), a row for every row of ``docs``; fails: a bit for each filter, A lowest."""
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    # the digest stands for the text, so that no text is moved
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), _fails("text").alias("own"))
    rows = stage(rows, "filtered")
    copied = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("labelled"))
    known = known.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(copied, "digest", "left").join(known, F.col("doc_id") == F.col("labelled"), "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    return rows.select("doc_id", "part", F.col("own").bitwiseOR(copy).alias("fails"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


# --- the tensors of one part

PASSES, FAILS, EITHER = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def contract(counts: np.ndarray, **axes: np.ndarray) -> int:
    """The documents that the given axes select; filters not named are ``either``."""
    return int(np.einsum("abcde,a,b,c,d,e->", counts, *(axes.get(name, EITHER) for name in FILTERS)))


def interactions(every: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """(filter_order, step, and the figures) for every order and step; three tensors of counts."""

    @cache
    def lost(name: str, before: frozenset) -> tuple[int, int, int, int]:
        chosen = dict.fromkeys(before, PASSES)
        gone = chosen | {name: FAILS}
        kept = contract(every, **chosen, **{name: PASSES})
        return kept, contract(every, **gone), contract(good, **gone), contract(toxic, **gone)

    failing = {name: contract(every, **{name: FAILS}) for name in FILTERS}
    alone = {name: contract(every, **(dict.fromkeys(FILTERS, PASSES) | {name: FAILS})) for name in FILTERS}
    orders = ["".join(order) for order in permutations(FILTERS)]
    steps = [(order, i, name, lost(name, frozenset(order[:i]))) for order in orders for i, name in enumerate(order)]
    shapley = dict.fromkeys(FILTERS, 0)
    for _, _, name, (_, removed, _, _) in steps:
        shapley[name] += removed
    return [
        (order, i + 1, kept, removed, failing[name] - removed, alone[name], good_lost, toxic_lost, shapley[name])
        for order, i, name, (kept, removed, good_lost, toxic_lost) in steps
    ]


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a part comes in: its pattern numbers and counts, at most 32 of them."""
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((name, pa.int64()) for name in FIGURES)])
    for batch in batches:
        for row in batch.to_pylist():
            tensors = np.zeros((3, 32), dtype=np.int64)
            for cell in row["cells"]:
                tensors[:, cell["fails"]] = cell["every"], cell["good"], cell["toxic"]
            # bit 0 is filter A, the first axis
            tensors = [t.reshape(2, 2, 2, 2, 2).transpose(4, 3, 2, 1, 0) for t in tensors]
            found = [(row["part"], *figures) for figures in interactions(*tensors)]
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows a part: every order of the filters, every step."""
    count = lambda which: F.count(F.when(F.col(which), 1)).alias(which)
    cells = marked(docs, labels).groupBy("part", "fails").agg(F.count("*").alias("every"), count("good"), count("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "every", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_audited, SCHEMA)

"""Suffix-array dedup: bytes of spans that occurred before are removed, by distributed prefix doubling.

Two positions of the corpus are equal up to ``span`` bytes if their ranks are, once prefix doubling has
passed ``span``. Doubling over every byte would sort the corpus several times over; it is done here on
the few positions that can still be equal, and on runs of positions at once.

**First ranks.** Every window of ``span`` bytes is ranked by the smallest hash among its runs of
``span // 2`` bytes, its anchor: equal windows have equal anchors at equal places. Neighbouring windows
share an anchor, so Spark counts anchors, not windows; those that occur once are unique and done.
Windows of one anchor in a row are a stretch. Equal stretches are found as wholes, and the first stands
for the others. Where all stretches of an anchor are equal, nothing is left to decide.

**Rounds.** Windows of an anchor are told apart by their offset, the bytes that they reach before it.
Block by block of offsets, all windows of a block share some bytes around the anchor, and halving the
blocks lets these bytes grow: 32 offsets share ``span - 31`` bytes, 16 share ``span - 15``, and so on to
``span``. In each round Spark sorts the pairs (rank so far, bytes that came to it) and numbers them
anew; a rank of one stretch is unique and leaves, and so do copies of an equal part of a stretch,
to be removed. The last round's blocks are single positions, equal in all of their ``span`` bytes.

Anchors are joined with the repeated ones after a bit table of these has left out most of the others.

**Order.** A window goes if an equal one starts earlier: in a smaller doc_id, or in the same text before.
Texts of equal bytes are one to begin with; all but that of the smallest doc_id go in whole.

A null text is empty; texts below ``span`` bytes stay as they are. Repeated rows (doc_id and text) are one
document and get equal results. Rows of one doc_id with different texts are ordered by a hash of the
text; a null doc_id comes after all others. Anchors and stretches are known by 64-bit hashes of two
different kinds; a false match needs both to collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import Table, bit_table, same, small_batches, text_key
from foliozone.llm.words import cuts, mix, nested, pair, raw
from foliozone.session import discard, stage

SPAN = 100
#: Bytes hashed at a time; longer texts are cut, with an overlap of a window.
PART = 1 << 20

_random = np.random.default_rng(11)
_LETTERS = _random.integers(0, 1 << 63, size=(2, 256), dtype=np.uint64)
_BASES = [int(b) | 1 for b in _random.integers(1 << 40, 1 << 62, size=2)]


class Rolled:
    """Hashes of any runs of bytes, from running sums of letter * base ** place."""

    def __init__(self, data: np.ndarray, kind: int):
        ahead, back = _powers(kind, len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_LETTERS[kind][data] * ahead[: len(data)], dtype=np.uint64)])
        self.back = back

    def every(self, size: int) -> np.ndarray:
        """Of the runs of ``size`` bytes at every place."""
        return (self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size]

    def at(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[first]) * self.back[first]


_known: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if kind not in _known or len(_known[kind][0]) < n:
        out = []
        for base in (_BASES[kind], pow(_BASES[kind], -1, 1 << 64)):
            steps = np.full(max(n, PART), base, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        _known[kind] = (out[0], out[1])
    return _known[kind]


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of every ``width`` values, the first among equals."""
    at, size = np.arange(len(values)), 1
    values = values.copy()

    def join(step: int) -> None:
        nonlocal values, at
        later = values[step:] < values[:-step]
        values, at = np.where(later, values[step:], values[:-step]), np.where(later, at[step:], at[:-step])

    while 2 * size <= width:
        join(size)
        size *= 2
    if size < width:
        join(width - size)
    return at


@dataclass
class Stretches:
    """Windows in a row with one anchor: text, starts of the first and the last window, anchor's place, both names."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    anchor: np.ndarray
    name: np.ndarray

    def __getitem__(self, rows: np.ndarray) -> Stretches:
        return Stretches(*(c[rows] for c in (self.text, self.first, self.last, self.at, self.anchor, self.name)))

    def fresh(self) -> np.ndarray:
        """Whether this is the first of its kind in its text (rows are in order of place)."""
        key = pair(pair(self.anchor, self.name), self.text.astype(np.uint64))
        out = np.zeros(len(key), dtype=bool)
        out[np.unique(key, return_index=True)[1]] = True
        return out


def _parts(texts: pa.Array, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets of the texts in them, number of the first text, bytes of it before these)."""
    at, data = raw(texts)
    for lo, hi in cuts(at, PART):
        size = int(at[hi] - at[lo])
        if size > 2 * PART and hi - lo == 1:
            for done in range(0, size - span + 1, PART):
                end = min(done + PART + span - 1, size)
                yield data[at[lo] + done : at[lo] + end], np.array([0, end - done]), lo, done
        else:
            yield data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], lo, 0


def stretches(texts: pa.Array, span: int) -> Stretches:
    out = []
    for data, offsets, lo, done in _parts(texts, span):
        n = len(data) - span + 1
        if n < 1:
            continue
        grams, windows = mix(Rolled(data, 0).every(span // 2)), Rolled(data, 1)
        at = lowest(grams, span - span // 2 + 1)[:n]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = text[:n] == text[span - 1 :]
        head = inside.copy()
        head[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
        first = np.flatnonzero(head)
        tail = inside.copy()
        tail[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
        last = np.flatnonzero(tail)
        names = pair(windows.at(first, first + span), pair(windows.at(last, last + span), (last - first).astype(np.uint64)))
        own = text[first]
        base = offsets[own] - done
        out.append((own + lo, first - base, last - base, at[first] - base, grams[at[first]], names))
    if not out:
        places = np.empty(0, dtype=np.int64)
        return Stretches(places, places, places, places, places.astype(np.uint64), places.astype(np.uint64))
    return Stretches(*(np.concatenate(c) for c in zip(*out, strict=True)))


# --- columns and rows in Python


def _anchors(span: int):
    """again: a stretch stands in the text twice; keys: its anchors, twice where stretches differ."""

    def named(texts: pa.Array) -> pa.Array:
        found = stretches(texts, span)
        fresh = found.fresh()
        again = np.zeros(len(texts), dtype=bool)
        again[found.text[~fresh]] = True
        found = found[fresh]
        order = np.lexsort((found.anchor, found.text))
        text, key = found.text[order], found.anchor[order]
        equal = np.concatenate([[False], (text[1:] == text[:-1]) & (key[1:] == key[:-1])]) if len(key) else np.empty(0, dtype=bool)
        third = equal & np.concatenate([[False], equal[:-1]])
        text, key = text[~third], key[~third]
        keys = nested(key.view(np.int64), np.bincount(text, minlength=len(texts)), pa.int64())
        return pa.StructArray.from_arrays([pa.array(again), keys], names=["again", "keys"])

    return arrow_udf(named, "struct<again:boolean,keys:array<bigint>>")


def _likely(table: Table):
    """The keys that may be in the table, each once."""

    def chosen(keys: pa.Array) -> pa.Array:
        flat, sizes = keys.flatten().to_numpy(zero_copy_only=False), keys.value_lengths().to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(len(sizes)), sizes)
        # keys of a text are in order
        new = np.concatenate([[True], (flat[1:] != flat[:-1]) | (text[1:] != text[:-1])])[: len(flat)]
        at = np.flatnonzero(new & table.check()(flat.view(np.uint64)))
        return nested(flat[at], np.bincount(text[at], minlength=len(sizes)), pa.int64())

    return arrow_udf(chosen, "array<bigint>")


_OWNER = "doc_id {id}, text_key bigint, at bigint, lo int, hi int"


def _found_stretches(span: int):
    """Rows of (doc_id, text_key, text, keys): the different stretches with one of these anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = stretches(batch.column(2), span)
            found = found[found.fresh()]
            wanted = batch.column(3)
            sizes = wanted.value_lengths().to_numpy(zero_copy_only=False)
            wish = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # an anchor and the text that wants it
            own = lambda key, text: pair(key, text.astype(np.uint64))
            found = found[np.isin(own(found.anchor, found.text), own(wish, np.repeat(np.arange(len(sizes)), sizes)))]
            row = pa.array(found.text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(found.at),
                    pa.array((found.at - found.last).astype(np.int32)),
                    pa.array((found.at - found.first).astype(np.int32)),
                    pa.array(found.anchor.view(np.int64)),
                    pa.array(found.name.view(np.int64)),
                ],
                names=["doc_id", "text_key", "at", "lo", "hi", "anchor", "name"],
            )

    return emit


def _with_bytes(span: int):
    """Rows of (doc_id, text_key, text, parts): a row for each part, with the bytes of its windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, parts = batch.column(2), [], []
            for i in range(len(batch)):
                data, own = (texts[i].as_py() or "").encode(), batch.column(3)[i].as_py()
                rows.extend([i] * len(own))
                parts.extend((p["at"], p["lo"], p["hi"], p["anchor"], data[p["at"] - p["hi"] : p["at"] - p["lo"] + span]) for p in own)
            at, lo, hi, rank, data = zip(*parts, strict=True) if parts else ((),) * 5
            row = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(at, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(rank, pa.int64()), pa.array(data, pa.binary())],
                names=["doc_id", "text_key", "at", "lo", "hi", "rank", "bytes"],
            )

    return emit


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same bytes as spans in order that neither meet nor touch."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _cut(span: int):
    """n_removed, kept_sha256 and the spans that go, of a text, its spans found elsewhere, and whether it repeats itself."""

    def cut(texts: pa.Array, found: pa.Array, again: pa.Array) -> pa.Array:
        spans = [[(s["first"], s["end"]) for s in own or ()] for own in found.to_pylist()]
        repeating = np.flatnonzero(again.to_numpy(zero_copy_only=False))
        if len(repeating):
            inside = stretches(texts.take(pa.array(repeating)), span)
            inside = inside[~inside.fresh()]
            for text, first, last in zip(inside.text.tolist(), inside.first.tolist(), inside.last.tolist(), strict=True):
                spans[repeating[text]].append((first, last + span))
        rows = []
        for text, own in zip(texts, spans, strict=True):
            data, kept, at, own = (text.as_py() or "").encode(), hashlib.sha256(), 0, joined(own)
            for first, end in own:
                kept.update(data[at:first])
                at = end
            kept.update(data[at:])
            rows.append({"n_removed": sum(b - a for a, b in own), "kept_sha256": kept.hexdigest(), "spans": [{"first": a, "end": b} for a, b in own]})
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        return pa.array(rows, pa.struct([("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", kind)]))

    return arrow_udf(cut, "struct<n_removed:bigint,kept_sha256:string,spans:array<struct<first:bigint,end:bigint>>>")


# --- on Spark


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key", "at")


def _halves(rows: DataFrame, half: int, span: int) -> DataFrame:
    """The parts of ``rows`` in the two halves of their blocks of offsets, with the bytes that each half's windows share beyond the block's."""

    def part(first: Column, start: Column, size: Column) -> Column:
        lo, hi = F.greatest("lo", first), F.least("hi", first + F.lit(half - 1))
        own = F.substring("bytes", F.col("hi") - hi + 1, F.lit(span) - lo + hi)
        return F.struct(first.alias("block"), lo.alias("lo"), hi.alias("hi"), own.alias("bytes"), F.substring("bytes", start + F.col("hi") + 1, size).alias("piece"))

    block = F.col("block")
    before = part(block, F.lit(span + 1 - 2 * half) - block, F.lit(half))  # grows to the right
    after = part(block + half, -block - half, F.lit(half))  # grows to the left
    parts = F.filter(F.array(before, after), lambda p: p["lo"] <= p["hi"])
    return rows.select("rank", "doc_id", "text_key", "at", F.explode(parts).alias("p")).select("rank", "doc_id", "text_key", "at", "p.*")


def _round(rows: DataFrame, half: int, span: int) -> DataFrame:
    """Parts of the next round, ranked anew, and those that are copies (``gone``); unique ones are left out."""
    parts = stage(_halves(rows, half, span).withColumn("name", F.xxhash64("bytes")).withColumn("from", _order()), "parts")
    pairs = ["rank", "block", "piece"]
    whole = [*pairs, "lo", "hi", "name"]
    firsts = stage(parts.groupBy(*whole).agg(F.min("from").alias("first"), F.count("*").alias("n")), "firsts")
    ranks = firsts.groupBy(*pairs).agg(F.count("*").alias("stretches")).filter("stretches > 1").orderBy(*pairs)
    ranks = stage(ranks.select(*pairs, F.monotonically_increasing_id().alias("next")), "ranks")
    known = firsts.join(ranks, pairs, "left").filter("n > 1 or next is not null").select(*whole, "first", "next")
    later = F.col("from") > F.col("first")
    found = parts.join(known, whole).withColumn("gone", later).filter(F.col("gone") | F.col("next").isNotNull())
    own = F.when(~F.col("gone"), F.col("bytes")).alias("bytes")
    found = stage(found.select(F.col("next").alias("rank"), "block", "lo", "hi", "doc_id", "text_key", "at", own, "gone"), "ranked")
    discard(parts, firsts, ranks)
    return found


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, n_bytes, n_removed, kept_sha256, spans), a row for every row of ``docs``; spans in bytes."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    small_batches(spark)
    text = F.coalesce("text", F.lit(""))
    owner = _OWNER.format(id=kind)
    seen = docs.select("doc_id", text_key().alias("text_key"), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("sha256"), _anchors(span)("text").alias("r"))
    anchored = stage(seen.select("doc_id", "text_key", "n_bytes", "sha256", "r.*"), "anchored")
    seen = stage(anchored.drop("keys", "again"), "texts")

    # one text stands for its copies: the smallest doc_id's
    texts = seen.filter(F.col("n_bytes") >= span).groupBy("sha256").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("rep"), F.count("*").alias("n"))
    texts = stage(texts.select("sha256", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"), "n"), "distinct_texts")
    own = anchored.filter(F.size("keys") > 0).select("doc_id", "text_key", "again", "keys").dropDuplicates(["doc_id", "text_key"])
    own = own.join(texts, same(own, texts, "doc_id", "text_key"), "left_semi")
    shared = stage(own.select(F.explode("keys").alias("anchor")).groupBy("anchor").count().filter("count > 1").select("anchor"), "shared_anchors")
    likely = _likely(bit_table(shared.select(F.col("anchor").alias("name"))))
    anchors = own.select("doc_id", "text_key", F.explode(likely("keys")).alias("anchor"))
    wanted = anchors.join(shared, "anchor", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_list("anchor").alias("keys"))
    wanted = stage(wanted, "wanted_anchors")
    repeating = stage(own.filter("again").select("doc_id", "text_key"), "repeating")
    discard(anchored, shared)

    keyed = docs.select("doc_id", text_key().alias("text_key"), text.alias("text"))
    once = lambda rows, *what: keyed.join(rows, same(keyed, rows, "doc_id", "text_key")).select(keyed["doc_id"], keyed["text_key"], "text", *what)
    found = once(wanted, "keys").mapInArrow(_found_stretches(span), f"{owner}, anchor bigint, name bigint")
    found = stage(found.withColumn("from", _order()), "stretches")
    discard(wanted)
    whole = ["anchor", "lo", "hi", "name"]
    firsts = stage(found.groupBy(*whole).agg(F.min("from").alias("first"), F.count("*").alias("n")), "distinct_stretches")
    copies = found.join(firsts.filter("n > 1").select(*whole, "first"), whole).filter(F.col("from") > F.col("first"))
    gone = [stage(copies.select("doc_id", "text_key", "at", "lo", "hi"), "copied_stretches")]
    discard(found)

    open_anchors = firsts.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1").select("anchor")
    rows = firsts.join(open_anchors, "anchor", "left_semi").select("first.doc_id", "first.text_key", F.struct("first.at", "lo", "hi", "anchor").alias("p"))
    parts = stage(rows.groupBy("doc_id", "text_key").agg(F.collect_list("p").alias("parts")), "open_stretches")
    discard(firsts)
    rows = stage(once(parts, "parts").mapInArrow(_with_bytes(span), f"{owner}, rank bigint, bytes binary").withColumn("block", F.lit(0)), "open_bytes")
    half = 1 << (span - span // 2).bit_length() - 1
    while half:
        ranked = _round(rows, half, span)
        gone.append(ranked.filter("gone").select("doc_id", "text_key", "at", "lo", "hi"))
        rows, half = ranked.filter("not gone"), half // 2

    place = F.struct((F.col("at") - F.col("hi")).cast("bigint").alias("first"), (F.col("at") - F.col("lo") + span).cast("bigint").alias("end"))
    spans = reduce(DataFrame.unionByName, gone).select("doc_id", "text_key", place.alias("s"), F.lit(False).alias("again"))
    repeating = repeating.select("doc_id", "text_key", F.lit(None).cast("struct<first:bigint,end:bigint>").alias("s"), F.lit(True).alias("again"))
    touched = stage(spans.unionByName(repeating).groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("found"), F.max("again").alias("again")), "touched")
    cut = once(touched, "found", "again").select("doc_id", "text_key", _cut(span)("text", "found", "again").alias("r")).dropDuplicates(["doc_id", "text_key"])
    cut = cut.select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "r.*")

    first = texts.filter("n > 1").select(F.col("sha256").alias("copied"), F.col("doc_id").alias("first_id"))
    rows = seen.join(first, seen["sha256"] == first["copied"], "left")
    rows = rows.join(cut, rows["doc_id"].eqNullSafe(cut["cut_id"]) & (rows["text_key"] == cut["cut_key"]), "left")
    copy = F.col("copied").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return rows.select(
        "doc_id",
        "text_key",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")

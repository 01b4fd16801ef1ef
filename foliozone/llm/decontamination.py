"""Benchmark decontamination by winnowing.

Both sides keep, of every ``W`` consecutive hashes of ``K`` words, the smallest. A span of
``W + K - 1`` = 13 words that both share has the same ``W`` hashes on both sides and so the same
smallest one: every shared span of 13 words or more shows as a shared fingerprint. Fingerprints
are joined, and each hit is extended to both sides, word by word, to what is really shared.

Items of 1 to 12 words count as a whole: their one fingerprint is that of all their words, and
documents give the hashes of those lengths that occur among the items.

Before the join, documents drop fingerprints that no item can have by a bit table of a fixed
``SLOTS`` bits; whatever passes it is joined exactly, so a larger benchmark only lets more pass.

Null and empty texts have no words and no hits; an empty benchmark leaves all documents clean.
Repeated rows get equal results, one each. Repeated items count once for each different item_id. Items without an id count like any other in
n_hit and contaminated; all of them together are one item more in n_items, and add nothing to the
digest of the ids.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import same, small_batches, text_key
from foliozone.llm.words import ALNUM, Block, blocks, follow, nested
from foliozone.session import stage

SPAN, K = 13, 7
W = SPAN - K + 1
#: Bits of the table that documents look up before the join (512 KB).
SLOTS = 1 << 22
#: A document is contaminated if this share of its words, or more, was hit.
SHARE = 20


def _of_size(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of different lengths never meet: the length is part of the hash."""
    return hashes ^ np.uint64(size * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def _winnow(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks the grams that are smallest in a window of ``W`` grams of one text.

    ``bounds``: of the texts in words; a text of n words has n - K + 1 grams, those that start
    later cross its end.
    """
    chosen = np.zeros(len(grams), dtype=bool)
    n = len(grams) - W + 1
    if n <= 0:
        return chosen
    low = grams[:n].copy()
    for j in range(1, W):
        np.minimum(low, grams[j : j + n], out=low)
    whole = np.zeros(n, dtype=bool)  # windows within one text
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole[:] = text[:n] == text[SPAN - 1 : SPAN - 1 + n]
    for j in range(W):
        chosen[j : j + n] |= whole & (grams[j : j + n] == low)
    return chosen


def fingerprints(block: Block, names: np.ndarray, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block and the text of each; ``short``: lengths below ``SPAN`` to hash whole."""
    text = np.repeat(np.arange(len(block.bounds) - 1), block.counts)
    hashes, owners = [], []
    grams = follow(names, K)
    at = np.flatnonzero(_winnow(grams, block.bounds))
    hashes.append(_of_size(grams[at], SPAN))
    owners.append(text[at])
    for size in short:
        grams = follow(names, size)
        n = len(grams)
        at = np.flatnonzero(text[:n] == text[size - 1 : size - 1 + n])
        hashes.append(_of_size(grams[at], size))
        owners.append(text[at])
    return np.concatenate(hashes), np.concatenate(owners)


def _item_prints(texts: pa.Array) -> pa.Array:
    """The fingerprints of every item: winnowed, or one of all its words if they are fewer than SPAN."""
    out, sizes = [], []
    for block in blocks(texts, ALNUM, lower=True):
        names = block.names()
        hashes, owners = fingerprints(block, names, ())
        for i, count in enumerate(block.counts):
            if 0 < count < SPAN:
                own = names[block.bounds[i] : block.bounds[i + 1]]
                found = _of_size(follow(own, int(count)), int(count))
            else:
                found = np.unique(hashes[owners == i])
            out.append(found)
            sizes.append(len(found))
    return nested(np.concatenate(out).view(np.int64) if out else [], np.array(sizes, dtype=np.int64), pa.int64())


def item_prints(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, n_words, fp): a row for every fingerprint of an item."""
    small_batches(benchmark.sparkSession)
    prints = arrow_udf(_item_prints, "array<bigint>")
    size = arrow_udf(lambda texts: pa.array(np.concatenate([b.counts for b in blocks(texts, ALNUM, lower=True)] or [[]]), pa.int64()), "bigint")
    items = benchmark.select("item_id", "text").distinct()
    return items.withColumn("n_words", size("text")).withColumn("fp", F.explode(prints("text")))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)


def _document_prints(table: bytes, short: tuple[int, ...]):
    bits = np.unpackbits(np.frombuffer(table, dtype=np.uint8)).astype(bool)

    def probe(texts: pa.Array) -> pa.Array:
        words, kept, sizes = [], [], []
        for block in blocks(texts, ALNUM, lower=True):
            hashes, owners = fingerprints(block, block.names(), short)
            may = bits[_slots(hashes)]
            # the same fingerprint of a text once
            both = np.unique(np.rec.fromarrays([owners[may], hashes[may]], names="o,h"))
            kept.append(both.h)
            sizes.append(np.bincount(both.o.astype(np.int64), minlength=len(block.counts)))
            words.append(block.counts)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        prints = nested(join(kept, np.uint64).view(np.int64), join(sizes, np.int64), pa.int64())
        return pa.StructArray.from_arrays([pa.array(join(words, np.int64), pa.int64()), prints], names=["n_words", "prints"])

    return arrow_udf(probe, "struct<n_words:bigint,prints:array<bigint>>")


def shared_spans(words: list[bytes], item: list[bytes], starts: dict[tuple, list[int]]) -> list[tuple[int, int]]:
    """Spans of a document's words that windows of the item cover: each hit extended to both sides.

    ``starts``: where runs of ``min(K, len(item))`` words start in the document.
    """
    size, most = min(K, len(item)), min(SPAN, len(item))
    out: list[tuple[int, int]] = []
    done: dict[int, int] = {}  # by diagonal: how far it has been extended
    for q in range(len(item) - size + 1):
        for p in starts.get(tuple(item[q : q + size]), ()):
            if done.get(p - q, -1) > p:
                continue
            a, b = p, p + size
            while a > 0 and q - (p - a) > 0 and words[a - 1] == item[q - (p - a) - 1]:
                a -= 1
            while b < len(words) and q + (b - p) < len(item) and words[b] == item[q + (b - p)]:
                b += 1
            done[p - q] = b
            if b - a >= most:
                out.append((a, b))
    return out


def _split(text: str | None) -> list[bytes]:
    for block in blocks(pa.array([text or ""]), ALNUM, lower=True, limit=1 << 62):
        data = block.data.tobytes()
        return [data[a:b] for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True)]
    return []


def _extend(texts: pa.Array, items: pa.Array) -> pa.Array:
    """n_hit, n_items and the digest of the ids of the items that occur."""
    known: dict[str, list[bytes]] = {}
    rows = []
    for text, wanted in zip(texts.to_pylist(), items.to_pylist(), strict=True):
        words = _split(text)
        sizes: dict[int, dict[tuple, list[int]]] = {}
        hit = np.zeros(len(words) + 1, dtype=np.int64)
        found = set()
        for each in wanted:
            if each["text"] not in known:
                if len(known) > 10_000:
                    known.clear()
                known[each["text"]] = _split(each["text"])
            item = known[each["text"]]
            size = min(K, len(item))
            if size not in sizes:
                starts = sizes[size] = defaultdict(list)
                for p in range(len(words) - size + 1):
                    starts[tuple(words[p : p + size])].append(p)
            for a, b in shared_spans(words, item, sizes[size]):
                hit[a] += 1
                hit[b] -= 1
                found.add(None if each["item_id"] is None else str(each["item_id"]))
        ids = sorted(found - {None}) + [None] * (None in found)
        rows.append({"n_hit": int((np.cumsum(hit)[:-1] > 0).sum()), "item_ids": ids})
    return pa.array(rows, pa.struct([("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string()))]))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids, contaminated), a row for every row of ``docs``.

    ``item_ids``: the items with occurring windows, as sorted strings, a null last for those without an id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = stage(item_prints(benchmark), "item_prints")
    short = tuple(sorted(r[0] for r in items.filter(F.col("n_words") < SPAN).select("n_words").distinct().collect()))
    shift = 64 - (SLOTS.bit_length() - 1)
    slots = items.select(F.shiftrightunsigned("fp", shift).alias("slot")).distinct()  # at most SLOTS rows
    bits = np.zeros(SLOTS, dtype=bool)
    bits[slots.toArrow()["slot"].to_numpy()] = True
    probe = _document_prints(np.packbits(bits).tobytes(), short)
    seen = docs.select("doc_id", text_key().alias("text_key"), probe("text").alias("r")).select("doc_id", "text_key", "r.*")
    seen = stage(seen, "document_prints")
    hits = (
        seen.filter(F.size("prints") > 0)
        .select("doc_id", "text_key", F.explode("prints").alias("fp"))
        .join(items.select("fp", "item_id", F.col("text").alias("item")), "fp")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("item_id", F.col("item").alias("text"))).alias("items"))
    )
    hits = stage(hits, "document_items")
    keyed = docs.select("doc_id", "text", text_key().alias("text_key"))
    hits_text = keyed.join(hits, same(keyed, hits, "doc_id", "text_key")).select(hits["doc_id"], hits["text_key"], "text", "items")
    extend = arrow_udf(_extend, "struct<n_hit:bigint,item_ids:array<string>>")
    verified = hits_text.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", extend("text", "items").alias("v"))
    verified = verified.select("doc_id", "text_key", "v.*").filter("n_hit > 0")
    return seen.join(verified, same(seen, verified, "doc_id", "text_key"), "left").select(
        seen["doc_id"],
        seen["text_key"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")), F.lit(False)).alias("contaminated"),
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )

"""Substring dedup by recompression: words of long spans that repeat anywhere are removed.

**Naming.** The words of all texts are named by 64-bit hashes, then recompressed in rounds: runs of
one word get one name, then, round by round, the names are split in two classes by a bit of their
hash and every pair (first class, second class) gets one name. Names depend on content alone, so
equal spans anywhere get equal names inside, without any exchange between tasks. With each symbol
goes the interval of words that decided it: a merged pair decides itself, a symbol that stays alone
also rests on the one neighbour it might have joined, a run on both. Wherever these words stand,
this symbol arises.

**Anchors.** A window of ``span`` words is known by the longest symbol of the last round whose
deciding words all lie inside it: equal windows have equal anchors. The few windows that hold none
(such as those inside a long run) are known by their own hash. So no window is missed, whatever the
symbols are. Spark counts each text's anchors over the corpus; those that occur once can't be in a
repeated window, and what is left is the neighbourhood of real repeats.

**Verification.** Windows that share an anchor with another place are hashed (128 bits over all
their words) and counted over the corpus, and joined back: windows counted twice or more repeat.

Texts of equal words are named as wholes first. Such a text of ``span`` words or more is removed
in whole, and one of its copies stands for all in the rounds, so a group of copies costs one text.

Windows are judged on the input: every place of a repeated span is removed, the first included.
Null and empty texts have no words; texts shorter than ``span`` words are kept as they are.
Repeated rows are documents of their own, and so copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import same, small_batches, text_key
from foliozone.llm.words import PLAIN, Block, blocks, follow, int_lists, mix, nested, pair
from foliozone.session import stage

SPAN = 35
#: Pair rounds, and the words a symbol may have.
ROUNDS, LONGEST = 5, 14

_RUN = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Symbols:
    """Symbols in order: their names, texts, sizes in words, and the words that decided each."""

    name: np.ndarray
    text: np.ndarray
    size: np.ndarray
    low: np.ndarray  # first deciding word
    high: np.ndarray  # after the last

    def __len__(self) -> int:
        return len(self.name)


def _neighbours(text: np.ndarray) -> np.ndarray:
    """Whether symbol i and i + 1 belong to one text."""
    return text[1:] == text[:-1]


def _merged(s: Symbols, heads: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> Symbols:
    return Symbols(name, s.text[heads], np.add.reduceat(s.size, heads) if len(heads) else s.size, low, high)


def name_runs(s: Symbols, bounds: np.ndarray) -> Symbols:
    """Every maximal run of one name becomes one symbol; it rests on the neighbours at both sides."""
    if not len(s):
        return s
    joined = np.concatenate([[False], _neighbours(s.text) & (s.name[1:] == s.name[:-1])])
    heads = np.flatnonzero(~joined)
    tails = np.concatenate([heads[1:], [len(s)]]) - 1
    count = tails - heads + 1
    name = np.where(count > 1, pair(s.name[heads] ^ _RUN, count.astype(np.uint64)), s.name[heads])
    text = s.text[heads]
    alone_left = np.concatenate([[True], text[1:] != text[:-1]])
    alone_right = np.concatenate([text[1:] != text[:-1], [True]])
    low = np.where(alone_left, bounds[text] - 1, s.low[heads - 1])
    high = np.where(alone_right, bounds[text + 1] + 1, s.high[np.minimum(tails + 1, len(s) - 1)])
    return _merged(s, heads, name, low, high)


def name_pairs(s: Symbols, bounds: np.ndarray, turn: int, longest: int) -> Symbols:
    """Pairs of a first-class and a second-class name become one symbol of ``longest`` words at most."""
    if not len(s):
        return s
    second = (mix(s.name ^ np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(1)).astype(bool)
    near = _neighbours(s.text)
    joins = near & ~second[:-1] & second[1:] & (s.size[1:] + s.size[:-1] <= longest)
    left, right = np.concatenate([joins, [False]]), np.concatenate([[False], joins])  # of a merged pair
    low, high = s.low.copy(), s.high.copy()
    lone = second & ~right  # rests on the symbol before
    at = np.flatnonzero(lone)
    first = np.concatenate([[True], ~near])
    low[at] = np.where(first[at], bounds[s.text[at]] - 1, s.low[at - 1])
    at = np.flatnonzero(~second & ~left)  # rests on the symbol after
    last = np.concatenate([~near, [True]])
    high[at] = np.where(last[at], bounds[s.text[at] + 1] + 1, s.high[np.minimum(at + 1, len(s) - 1)])
    heads = np.flatnonzero(~right)
    both = left[heads]
    name, up = s.name[heads], high[heads]
    name[both] = pair(s.name[heads[both]], s.name[heads[both] + 1])
    up[both] = high[heads[both] + 1]
    return _merged(s, heads, name, low[heads], up)


def recompress(names: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS, longest: int = LONGEST) -> Symbols:
    """The symbols of the last round; ``bounds``: of the texts in words."""
    at = np.arange(len(names))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    s = name_runs(Symbols(names, text, np.ones(len(names), dtype=np.int64), at, at + 1), bounds)
    for turn in range(1, rounds + 1):
        s = name_pairs(s, bounds, turn, longest)
    return s


def _keys(s: Symbols) -> np.ndarray:
    """Names that compare by size first."""
    return (np.minimum(s.size, 63).astype(np.uint64) << np.uint64(58)) | (s.name >> np.uint64(6))


def window_keys(names: np.ndarray, bounds: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, Symbols]:
    """(starts, keys, bare, symbols): every window's anchor; bare: windows known by their own hash."""
    s = recompress(names, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(text[: max(0, len(text) - span + 1)] == text[span - 1 :])
    if not len(starts):
        none = np.empty(0, dtype=np.uint64)
        return starts, none, np.empty(0, dtype=bool), s
    # symbols a..b-1 are decided inside the window: low and high never fall from one symbol to the next
    a = np.cumsum(np.bincount(s.low + 2, minlength=len(names) + 3))[starts + 1]
    b = np.cumsum(np.bincount(s.high, minlength=len(names) + 3))[starts + span]
    tops, out, n = _keys(s), np.zeros(len(starts), dtype=np.uint64), b - a
    for level in range(int(max(n.max(), 1)).bit_length()):
        at = np.flatnonzero((n >> level) == 1)
        out[at] = np.maximum(tops[a[at]], tops[b[at] - (1 << level)])
        tops = np.maximum(tops[: -(1 << level)], tops[1 << level :]) if len(tops) > 1 << level else tops
    bare = n <= 0
    if bare.any():
        out[bare] = follow(names, span)[starts[bare]] >> np.uint64(6)
    return starts, out, bare, s


def text_keys(names: np.ndarray, bounds: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the anchors of each text's windows, twice where the text has the anchor twice."""
    starts, keys, bare, s = window_keys(names, bounds, span)
    if not len(starts):
        return starts, keys
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[starts]
    own = lambda k, t: k ^ mix(t.astype(np.uint64) + _RUN)
    there, times = np.unique(np.concatenate([own(_keys(s), s.text), own(keys[bare], text[bare])]), return_counts=True)
    change = np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])])
    keys, text = keys[change], text[change]
    chosen, at = np.unique(own(keys, text), return_index=True)
    twice = times[np.searchsorted(there, chosen)] > 1
    keys, text = np.concatenate([keys[at], keys[at[twice]]]), np.concatenate([text[at], text[at[twice]]])
    order = np.argsort(text, kind="stable")
    return text[order], keys[order]


def window_hashes(names: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Two names of every run of ``span`` words, made from different pieces."""
    back = follow(names[::-1] ^ _RUN, span)[::-1]
    return follow(names, span), back


def spans_of(starts: list[int], span: int) -> list[tuple[int, int]]:
    """The words that windows at these starts cover, as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for p in sorted(starts):
        if out and p <= out[-1][1]:
            out[-1] = (out[-1][0], p + span)
        else:
            out.append((p, p + span))
    return out


# --- on Spark


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _wholes(block: Block, names: np.ndarray) -> np.ndarray:
    """A name for the word sequence of each text."""
    n = block.counts
    place = np.arange(len(names)) - np.repeat(block.bounds[:-1], n)
    out = mix(n.astype(np.uint64) + _RUN)
    if len(names):
        full = np.flatnonzero(n)
        out[full] = mix(out[full] ^ np.add.reduceat(mix(names + place.astype(np.uint64) * _RUN), block.bounds[full]))
    return out


def _named(span: int):
    """n_words, whole (the name of all words), sha256 of all words, and the keys of the anchors."""

    def named(texts: pa.Array) -> pa.Array:
        n, wholes, keys, sizes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        shas = []
        for block in blocks(texts, PLAIN):
            names = block.names()
            owner, found = text_keys(names, block.bounds, span)
            n.append(block.counts)
            wholes.append(_wholes(block, names))
            keys.append(found)
            sizes.append(np.bincount(owner, minlength=len(block.counts)))
            shas.extend(_digest(block.text(i).split()) for i in range(len(block.counts)))
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(n), pa.int64()),
                pa.array(np.concatenate(wholes).view(np.int64), pa.int64()),
                pa.array(shas, pa.string()),
                nested(np.concatenate(keys).view(np.int64), np.concatenate(sizes), pa.int64()),
            ],
            names=["n_words", "whole", "sha256", "keys"],
        )

    return arrow_udf(named, "struct<n_words:bigint,whole:bigint,sha256:string,keys:array<bigint>>")


def _candidate_windows(span: int):
    """Rows (whole, n_words, start, h, back) of the windows whose anchors stand elsewhere too."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, wanted = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            for block in blocks(batch.column(2), PLAIN):
                names = block.names()
                starts, keys, _, _ = window_keys(names, block.bounds, span)
                if not len(starts):
                    continue
                text = np.repeat(np.arange(len(block.counts)), block.counts)[starts]
                edges = np.searchsorted(text, np.arange(len(block.counts) + 1))
                take = np.zeros(len(starts), dtype=bool)
                for i in range(len(block.counts)):
                    own = slice(edges[i], edges[i + 1])
                    take[own] = np.isin(keys[own], np.asarray(wanted[block.first + i], dtype=np.int64).view(np.uint64))
                at, text = starts[take], text[take]
                ahead, back = window_hashes(names, span)
                row = block.first + text
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(sizes[row]), pa.array((at - block.bounds[text]).astype(np.int32)), pa.array(ahead[at].view(np.int64)), pa.array(back[at].view(np.int64))],
                    names=["whole", "n_words", "start", "h", "back"],
                )

    return emit


def _removed(span: int):
    """n_removed, sha256 of the words that stay, and the spans removed."""

    def remove(texts: pa.Array, starts: pa.Array) -> pa.Array:
        rows = []
        for text, at in zip(texts.to_pylist(), int_lists(starts), strict=True):
            words, kept, last = (text or "").encode().split(), [], 0
            spans = spans_of(at, span)
            for a, b in spans:
                kept.extend(words[last:a])
                last = b
            kept.extend(words[last:])
            rows.append({"n_removed": len(words) - len(kept), "kept_sha256": _digest(kept), "spans": [{"first": a, "end": b} for a, b in spans]})
        spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        return pa.array(rows, pa.struct([("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", spans)]))

    return arrow_udf(remove, "struct<n_removed:bigint,kept_sha256:string,spans:array<struct<first:bigint,end:bigint>>>")


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, n_words, n_removed, kept_sha256, spans), a row for every row of ``docs``.

    ``spans``: the words removed, from 0, end exclusive.
    """
    small_batches(docs.sparkSession)
    seen = stage(docs.select("doc_id", text_key().alias("text_key"), _named(span)("text").alias("r")).select("doc_id", "text_key", "r.*"), "named_texts")
    me = F.struct("doc_id", "text_key")
    texts = seen.filter(F.col("n_words") >= span).groupBy("whole", "n_words").agg(F.count("*").alias("copies"), F.min(me).alias("rep"))
    texts = stage(texts, "distinct_texts")  # one copy stands for all
    copied = texts.filter("copies > 1").select("whole", "n_words", "copies")
    reps = texts.select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"), "whole", "n_words")
    own = seen.filter(F.col("n_words") >= span).select("doc_id", "text_key", "keys").dropDuplicates(["doc_id", "text_key"])
    anchors = own.join(reps, same(own, reps, "doc_id", "text_key")).select("whole", "n_words", F.explode("keys").alias("key"))
    shared = stage(anchors.groupBy("key").count().filter("count > 1").select("key"), "shared_anchors")
    wanted = anchors.join(shared, "key", "left_semi").groupBy("whole", "n_words").agg(F.collect_set("key").alias("keys"))
    wanted = stage(texts.join(wanted, ["whole", "n_words"]).select("rep", "whole", "n_words", "keys"), "wanted_anchors")
    wanted = wanted.select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"), "whole", "n_words", "keys")
    keyed = docs.select("doc_id", "text", text_key().alias("text_key"))
    found = keyed.join(wanted, same(keyed, wanted, "doc_id", "text_key")).select("whole", "n_words", "text", "keys")
    windows = found.mapInArrow(_candidate_windows(span), "whole bigint, n_words bigint, start int, h bigint, back bigint")
    windows = stage(windows, "windows")
    # written, so that the join below reads plain exchanges, whose hot partitions Spark can split
    again = stage(windows.groupBy("h", "back").count().filter("count > 1").select("h", "back"), "repeated_hashes")
    hits = windows.join(again, ["h", "back"], "left_semi").groupBy("whole", "n_words").agg(F.collect_set("start").alias("starts"))
    # texts with copies go in whole: only the others are read again
    hits = stage(hits.join(copied, ["whole", "n_words"], "left_anti").join(texts.select("whole", "n_words", "rep"), ["whole", "n_words"]), "repeated_windows")
    hits = hits.select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"), "whole", "n_words", "starts")
    cut = keyed.join(hits, same(keyed, hits, "doc_id", "text_key")).select("whole", "n_words", _removed(span)("text", "starts").alias("r"))
    cut = cut.select("whole", "n_words", "r.*")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_words").alias("end")))
    gone = copied.select("whole", "n_words", F.col("n_words").alias("n_removed"), F.lit(nothing).alias("kept_sha256"), whole.alias("spans"))
    changed = cut.unionByName(gone)
    return seen.join(changed, ["whole", "n_words"], "left").select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,end:bigint>>")).alias("spans"),
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256")

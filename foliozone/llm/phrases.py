"""Phrase collocations from a weighted de Bruijn graph of words.

**Graph.** Texts are cut into pieces and words. Every run of ``LONGEST`` (4) words inside a piece is an
edge between two nodes, its first and its last three words; Spark sums equal edges, after each task
has summed its own. A piece also ends: its last three, two and one words are the start of no edge, and
their numbers are the corrections of the piece ends.

**Flow.** What a node was seen is what flows out of it: the sum of its edges and the pieces that end in
it. The same sum over the nodes that start with two words, plus the ends in these two, counts the
pair; and over pairs the single words. So one shuffle of edges gives the counts of all lengths.

**Paths.** Among the frequent edges, a node with one edge in and one out only passes its flow on: such
edges are joined to paths by pointer doubling. Paths are the fixed expressions, of any length, and the
candidates of four words are read off them. Edges of a closed ring stay paths of one edge each.

A phrase is frequent with ``least`` occurrences, and so are all its parts. A rarer word ends a piece,
which leaves the counts of frequent phrases as they are. So words are counted first, and a bit table of
the frequent ones goes to the tasks; what it takes for frequent by mistake costs an edge more, nothing
else. Edges are dealt by their first two words, so that pairs are counted where their edges are; those
that start with one of the few heaviest words are dealt by three, and their pairs are summed once
more. Words are 64-bit names of language and word, phrases are told apart by their words' names.

A null text is empty, a null lang is ``und``. Repeated rows count each. Ties of score and number go by
phrase. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliozone.llm.tables import Table, bit_table, small_batches
from foliozone.llm.words import Block, blocks, byte_class, mix
from foliozone.session import stage

#: A phrase seen less often is no candidate; one that a longer phrase explains to this percentage is dropped.
LEAST, EXPLAINED = 30, 80
#: A language's report, and what scores are counted in.
MOST, SCALE = 2000, 2_000_000
LONGEST = 4
#: A word with more than this share of all words is heavy; so there are fewer than 1 / HEAVY of them.
HEAVY = 0.002

#: Bytes of text whose words a task counts together.
TOGETHER = 2 << 20
#: Rows that a task sums before it hands them on, and those it hands on at once.
HELD, HANDED = 1 << 18, 1 << 15

STOPS = byte_class(*((b, b) for b in b".,;:!?"), (0x0A, 0x0D))
WORD = ~(STOPS | byte_class((0x20, 0x20), (0x09, 0x09)))

NAMES = ["w1", "w2", "w3", "w4"]


# --- in a task


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about TOGETHER bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= TOGETHER:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, Block]]:
    """(names, pieces, languages, block) of the words of each block of (lang, text)."""
    for batch in _gathered(batches):
        lang = batch.column(0).dictionary_encode()
        keys = np.array([xxhash.xxh64_intdigest(v.encode(), LONGEST) for v in lang.dictionary.to_pylist()], dtype=np.uint64)
        own = lang.indices.to_numpy(zero_copy_only=False)
        for block in blocks(batch.column(1), WORD, lower=True, limit=TOGETHER):
            which = np.repeat(own[block.first : block.last], block.counts)
            ends = np.concatenate([[0], np.cumsum(STOPS[block.data], dtype=np.int32)])
            # texts and stops before a word, together, number its piece
            piece = ends[block.starts] + np.repeat(np.arange(len(block.counts)), block.counts)
            # 0 marks the end of a piece
            yield np.maximum(mix(block.names() ^ keys[which]), 1), piece, pa.DictionaryArray.from_arrays(which, lang.dictionary), block


def _sums(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows once, with the sum of their counts."""
    if not len(counts):
        return columns, counts
    # by some bits of the first words, then of all: rows that start alike lie together, which packs well
    key = columns[-1]
    for column in columns[:-1]:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    key = (columns[0] & np.uint64(0xFFFFF << 44)) | (columns[1] >> np.uint64(48) << np.uint64(28)) | (key >> np.uint64(36))
    order = np.argsort(key, kind="stable")
    columns = [c[order] for c in columns]
    # rows are compared, not their keys: rows of one key that differ stay apart
    new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    heads = np.concatenate([[0], np.flatnonzero(new) + 1])
    return [c[heads] for c in columns], np.add.reduceat(counts[order], heads)


def _merged(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    return _sums([np.concatenate(c) for c in zip(*(columns for columns, _ in parts), strict=True)], np.concatenate([n for _, n in parts]))


def _summed(parts: Iterator[tuple[list[np.ndarray], np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of columns and counts, summed as far as HELD rows go."""

    def rows(columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(counts), HANDED):
            part = slice(k, k + HANDED)
            yield pa.RecordBatch.from_arrays([*(pa.array(c[part].view(np.int64)) for c in columns), pa.array(counts[part])], names=[*names, "n"])

    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[1])
        if size > HELD:
            held, before = [_merged(held)], size
            size = len(held[0][1])
            if 2 * size > before:  # mostly different ones
                yield from rows(*held[0])
                held, size = [], 0
    if held:
        yield from rows(*_merged(held))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, name, word, n)."""
    for names, _, langs, block in _pieces(batches):
        if not len(names):
            continue
        found, at, n = np.unique(names, return_index=True, return_counts=True)
        size = block.ends[at] - block.starts[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = block.data[np.arange(offsets[-1]) + np.repeat(block.starts[at] - offsets[:-1], size)]
        words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        rows = pa.RecordBatch.from_arrays([langs.take(pa.array(at)).dictionary_decode(), pa.array(found.view(np.int64)), words.cast(pa.string()), pa.array(n)], names=["lang", "name", "word", "n"])
        yield from (rows.slice(k, HANDED) for k in range(0, len(n), HANDED))


def edges_of(names: np.ndarray, frequent: np.ndarray, joined: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal runs of four words once, with their number; 0 stands for what is not there, at the end of a piece.

    ``joined``: whether a word goes on to the next one.
    """
    places = np.flatnonzero(frequent)
    live, columns = np.ones(len(places), dtype=bool), [names[places]]
    for k in range(1, LONGEST):
        inside = places + k < len(names)  # behind the last word there is none, whatever the one before it joins
        at = np.where(inside, places + k, 0)
        live = live & inside & joined[at - 1]
        columns.append(np.where(live, names[at], np.uint64(0)))
    return _sums(columns, np.ones(len(places), dtype=np.int64))


def _edges(words: Table):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.check()

        def parts():
            for names, pieces, _, _ in _pieces(batches):
                frequent, joined = known(names), np.zeros(len(names), dtype=bool)
                joined[:-1] = frequent[:-1] & frequent[1:] & (pieces[:-1] == pieces[1:])
                yield edges_of(names, frequent, joined)

        yield from _summed(parts(), NAMES)

    return count


# --- on Spark


def word_counts(docs: DataFrame) -> DataFrame:
    """(name, lang, word, n), of every word of every language."""
    counted = _texts(docs).mapInArrow(_count_words, "lang string, name bigint, word string, n bigint")
    return counted.groupBy("name", "lang", "word").agg(F.sum("n").alias("n"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """(w1, w2, w3, w4, n), of every phrase of up to four words with ``least`` occurrences; 0 for no word."""
    often = bit_table(words.filter(F.col("n") >= least).select("name"))
    heavy = [r[0] for r in words.filter(F.col("n") > HEAVY * (words.agg(F.sum("n")).first()[0] or 0)).select("name").collect()]
    salt = F.when(F.col("w1").isin(heavy), F.col("w3")).otherwise(0).alias("salt")
    # tasks have summed their own: a hot node costs a task no more rows than it has different successors
    edges = _texts(docs).mapInArrow(_edges(often), "w1 bigint, w2 bigint, w3 bigint, w4 bigint, n bigint")
    edges = edges.select("*", salt).repartition("w1", "w2", "salt").groupBy("w1", "w2", "salt", "w3", "w4").agg(F.sum("n").alias("n"))
    kept = F.when((F.col("w4") != 0) & (F.col("n") >= least), F.struct("w4", "n"))
    nodes = edges.groupBy("w1", "w2", "salt", "w3").agg(F.sum("n").alias("flow"), F.collect_list(kept).alias("edges"))
    kept = F.when((F.col("w3") != 0) & (F.col("flow") >= least), F.struct("w3", "flow", "edges"))
    pairs = nodes.groupBy("w1", "w2", "salt").agg(F.sum("flow").alias("flow"), F.collect_list(kept).alias("nodes"))

    def row(w2: str | int, w3: Column | int, w4: Column | int, n: str | Column) -> Column:
        column = lambda v: v if isinstance(v, Column) else F.lit(v).cast("bigint") if isinstance(v, int) else F.col(v)
        return F.struct("w1", column(w2).alias("w2"), column(w3).alias("w3"), column(w4).alias("w4"), column(n).alias("n"))

    none = F.array().cast("array<struct<w1:bigint,w2:bigint,w3:bigint,w4:bigint,n:bigint>>")
    open_pair = (F.col("w2") != 0) & ((F.col("flow") >= least) | F.col("w1").isin(heavy))
    below = lambda x: F.concat(F.array(row("w2", x["w3"], 0, x["flow"])), F.transform(x["edges"], lambda e: row("w2", x["w3"], e["w4"], e["n"])))
    flows = F.concat(F.array(row(0, 0, 0, "flow")), F.when(open_pair, F.array(row("w2", 0, 0, "flow"))).otherwise(none), F.flatten(F.transform("nodes", below)))
    return pairs.select(F.explode(flows).alias("f")).select("f.*").groupBy(*NAMES).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def paths(edges: DataFrame) -> DataFrame:
    """(path, words, counts): unary paths of the given edges (w1..w4, n); words: names, counts: of the edges in order.

    A path is named by its first edge's number, which holds within the result alone.
    """
    edges = stage(edges.select(F.monotonically_increasing_id().alias("id"), *NAMES, "n"), "edges")
    before = edges.groupBy(F.col("w2").alias("a"), F.col("w3").alias("b"), F.col("w4").alias("c")).agg(F.count("*").alias("into"), F.min("id").alias("up")).filter("into = 1")
    after = edges.groupBy(F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("w3").alias("c")).agg(F.count("*").alias("out"), F.min("id").alias("id")).filter("out = 1")
    links = before.join(after, ["a", "b", "c"]).select("id", "up").filter("id <> up")
    place = edges.select("id").join(links, "id", "left").select("id", F.coalesce("up", "id").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("step"))
    place, open_before = stage(place.withColumn("done", F.col("up") == F.col("id")), "places"), None
    while True:
        # finished: what points at a first edge; in a ring nothing ever is
        still_open = place.filter("not done").count()
        if still_open in (0, open_before):
            break
        open_before = still_open
        ahead = place.select(F.col("id").alias("up"), F.col("up").alias("further"), F.col("step").alias("more"), F.col("done").alias("ended"))
        place = stage(place.join(ahead, "up").select("id", F.col("further").alias("up"), (F.col("step") + F.col("more")).alias("step"), F.col("ended").alias("done")), "places")
    place = place.select("id", F.when(F.col("done"), F.col("up")).otherwise(F.col("id")).alias("path"), F.when(F.col("done"), F.col("step")).otherwise(0).alias("step"))
    rows = place.join(edges, "id").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("step", *NAMES, "n"))).alias("e"))
    first = F.col("e")[0]
    words = F.concat(F.array(first["w1"], first["w2"], first["w3"]), F.transform("e", lambda e: e["w4"]))
    return rows.select("path", words.alias("words"), F.transform("e", lambda e: e["n"]).alias("counts"))


def expressions(found: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, expression, n_words, least, most): the paths as text, and the least and most occurrences of their edges."""
    least, most = F.array_min("counts").alias("least"), F.array_max("counts").alias("most")
    texts = _in_words(found.select("path", "words"), "path", words)
    return found.select("path", F.size("words").cast("bigint").alias("n_words"), least, most).join(texts, "path").select("lang", F.col("phrase").alias("expression"), "n_words", "least", "most")


def _in_words(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """(key, lang, phrase) of rows (key, words), words as names."""
    placed = rows.select(key, F.posexplode("words").alias("at", "name")).join(words.select("name", "lang", "word"), "name")
    rows = placed.groupBy(key).agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    return rows.select(key, "lang", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("phrase"))


def _part(first: int, size: int) -> Column:
    """Some words of a phrase as a phrase: a struct of four names."""
    return F.struct(*((F.col(NAMES[first + i]) if i < size else F.lit(0).cast("bigint")).alias(NAMES[i]) for i in range(LONGEST)))


def _size() -> Column:
    return sum(((F.col(name) != 0).cast("int") for name in NAMES), F.lit(0))


def _by_size(choices: dict[int, list[Column]]) -> Column:
    out = None
    for size, structs in choices.items():
        out = F.when(_size() == size, F.array(*structs)) if out is None else out.when(_size() == size, F.array(*structs))
    return out


def score_of(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(SCALE * a / (l + r)), exactly."""
    return F.expr(f"(cast({a} as decimal(20,0)) * {SCALE}) div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))").cast("bigint")


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """candidates (w1..w4, a) with l, r and score of their weakest cut, ties to the first."""
    cuts = _by_size({s: [F.struct(F.lit(k).alias("k"), _part(0, k).alias("head"), _part(k, s - k).alias("tail")) for k in range(1, s)] for s in range(2, LONGEST + 1)})
    rows = candidates.select(*NAMES, "a", F.explode(cuts).alias("c")).select(*NAMES, "a", "c.k", *(F.col(f"c.{side}.{w}").alias(side[0] + w) for side in ("head", "tail") for w in NAMES))
    for side, out in (("h", "l"), ("t", "r")):
        part = counts.select(*(F.col(w).alias(side + w) for w in NAMES), F.col("n").alias(out))
        rows = rows.join(part, [side + w for w in NAMES])
    weakest = F.min(F.struct(score_of("a", "l", "r").alias("score"), "k", "l", "r")).alias("m")
    return rows.groupBy(*NAMES, "a").agg(weakest).select(*NAMES, "a", "m.l", "m.r", "m.score")


def unexplained(candidates: DataFrame) -> DataFrame:
    """The candidates (w1..w4, a) that no longer candidate holds about as often."""
    inner = _by_size({s: [_part(i, k) for k in range(2, s) for i in range(s - k + 1)] for s in range(3, LONGEST + 1)})
    held = candidates.filter("w3 <> 0").select(F.explode(inner).alias("p"), F.col("a").alias("longer")).groupBy("p.w1", "p.w2", "p.w3", "p.w4").agg(F.max("longer").alias("longer"))
    explained = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {EXPLAINED}")
    return candidates.join(held, NAMES, "left").filter(F.col("longer").isNull() | ~explained).select(*NAMES, "a")


def mine(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases."""
    small_batches(docs.sparkSession)
    words = stage(word_counts(docs), "words")
    counts = stage(phrase_counts(docs, words, least), "phrases")
    found = paths(counts.filter("w4 <> 0"))
    longest = found.select(F.explode(F.transform("counts", lambda n, i: F.struct(n.alias("a"), F.slice("words", i + 1, F.lit(LONGEST)).alias("w")))).alias("e"))
    longest = longest.select(*(F.col("e.w")[i].alias(name) for i, name in enumerate(NAMES)), "e.a")
    candidates = stage(longest.unionByName(counts.filter("w2 <> 0 and w4 = 0").withColumnRenamed("n", "a")), "candidates")
    rows = scored(unexplained(candidates), counts)
    spoken = words.select(F.col("name").alias("w1"), "lang", "word")
    rows = rows.join(spoken.select("w1", "lang"), "w1")
    # all that ties with the last one goes on, to be ordered by phrase
    level = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    rows = stage(rows.withColumn("level", F.rank().over(level)).filter(F.col("level") <= most).drop("level").withColumn("id", F.monotonically_increasing_id()), "strongest")
    present = F.filter(F.array(*NAMES), lambda w: w != 0)
    texts = _in_words(rows.select("id", present.alias("words")), "id", words)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rows = rows.drop("lang").join(texts, "id").join(total, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= most)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

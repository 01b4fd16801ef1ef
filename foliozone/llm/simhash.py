"""SimHash near-duplicates: fingerprints of word shingles, linked at few differing bits.

Search by the general pigeonhole principle: the 64 bits are dealt to ``m`` parts with thresholds
t_1..t_m that add up to ``distance - m + 1``. Two fingerprints that differ in ``distance`` bits or
fewer differ in some part i by t_i bits or fewer (a threshold of -1 leaves a part out). Bits that
go together are put into one part, so that the parts are as independent as they can be; thresholds
come from dynamic programming over the number of rows and candidates that each would cost, and so
does m: the more fingerprints, the fewer and longer the parts.

Every distinct fingerprint is indexed under its value of each part and probes all values within
the part's threshold. Buckets are dealt out by hash and read in order. In a small bucket all pairs
are compared; a larger one is searched breadth first, each found fingerprint looking only at those
not reached yet, which gives a spanning forest of its links instead of all pairs. A bucket of more
than ``MOST`` rows is dealt to blocks, and every pair of blocks is searched so, in its own task.
Components of the links then span all documents.

Null, empty and blank texts have the fingerprint zero and link like any other. Repeated rows get
equal results, one each. ``component_id`` is the smallest doc_id that is not null of a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from foliozone.llm.components import components
from foliozone.llm.tables import same, small_batches, text_key, wrapped
from foliozone.session import stage

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Buckets up to SMALL rows compare all pairs; buckets over MOST rows are dealt to blocks.
SMALL, MOST = 64, 20_000
#: The cost of comparing a candidate, in rows written.
COMPARE = 0.02

_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' hashes, repeats included."""
    words = text.lower().split()  # of bytes: lowers A-Z and splits at ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(flat, dtype=np.uint8) == 0x20)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(flat)]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(flat[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)] or [digest(flat, SEED)]
    values, n = np.array(hashes, dtype=np.uint64), len(hashes)
    out = 0
    for shift in range(8):  # eight counters at once, a byte each; 255 values do not overflow it
        sums = np.add.reduceat((values >> np.uint64(shift)) & _LANES, np.arange(0, n, 255))
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n).tolist():
            out |= 1 << (8 * byte + shift)
    return out


def fingerprints_of(shingle: int):
    def prints(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint((t or "").encode(), shingle) for t in texts.to_pylist()), dtype=np.uint64, count=len(texts))
        return pa.array(found.view(np.int64))

    return arrow_udf(prints, LongType())


fingerprints = fingerprints_of(SHINGLE)


# --- the plan of a search


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have both bits i and j: 64 x 64, over all fingerprints."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = _bits(np.ascontiguousarray(values)).astype(np.float32)
            total += bits.T @ bits
        cells = np.arange(4096)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel().astype(np.int64))], names=["cell", "n"])

    cells = prints.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(4096)
    for cell, n in cells:
        out[cell] = n
    return out.reshape(64, 64)


@dataclass(frozen=True)
class Plan:
    parts: tuple[tuple[int, ...], ...]
    limits: tuple[int, ...]
    cost: float


def group_bits(together: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """Deals the bits to m parts: each takes the bits that correlate most with those it has."""
    left, parts = set(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        seed = max(left, key=lambda b: (together[b, list(left)].sum(), -b))
        part = [seed]
        left.discard(seed)
        while len(part) < size:
            part.append(max(left, key=lambda b: (together[b, part].sum(), -b)))
            left.discard(part[-1])
        parts.append(tuple(part))
    return parts


def allocate(costs: list[list[float]], total: int) -> tuple[float, tuple[int, ...]]:
    """The cheapest thresholds with the given sum; ``costs[i][t + 1]``: of threshold t in part i."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for part in costs:
        grown: dict[int, tuple[float, tuple[int, ...]]] = {}
        for have, (cost, limits) in best.items():
            for k, more in enumerate(part):
                key, value = have + k - 1, (cost + more, (*limits, k - 1))
                if key not in grown or value < grown[key]:
                    grown[key] = value
        best = grown
    return best[total]


def plan(n: int, counts: np.ndarray, distance: int = DISTANCE) -> Plan:
    """Parts and thresholds for n fingerprints with these counts of bits."""
    share = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    together = np.abs(counts / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    differ = 2 * share * (1 - share)  # the chance that two fingerprints differ in a bit
    found = None
    for m in range(2, distance + 2):
        parts, costs = group_bits(together, m), []
        for part in parts:
            chance = np.array([1.0])  # of 0, 1, 2.. differing bits in this part
            for b in part:
                chance = np.convolve(chance, [1 - differ[b], differ[b]])
            ball = np.cumsum([math.comb(len(part), t) for t in range(distance + 1)])
            costs.append([0.0, *(n * float(ball[t]) + COMPARE * n * n * float(chance[: t + 1].sum()) for t in range(distance + 1))])
        cost, limits = allocate(costs, distance - m + 1)
        if found is None or cost < found.cost:
            found = Plan(tuple(parts), limits, cost)
    return found


# --- the search


def probes(values: np.ndarray, how: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, fingerprints): the own bucket of each part, and those within its threshold."""
    for i, (part, limit) in enumerate(zip(how.parts, how.limits, strict=True)):
        if limit < 0:
            continue
        own = np.zeros(len(values), dtype=np.uint64)
        for k, bit in enumerate(part):
            own |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
        own |= np.uint64(i << 56)
        for t in range(limit + 1):
            for flips in combinations(range(len(part)), t):
                yield own ^ np.uint64(sum(1 << k for k in flips)), values


def _search(bucket: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket that connect all that its links connect."""
    left, first, second = np.unique(bucket), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                got, left = left[near], left[~near]
                queue.extend(got)
                first.append(np.full(len(got), at))
                second.append(got)
    return (np.concatenate(first), np.concatenate(second)) if first else (left, left)


def links_of(keys: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets; ``keys`` (rows of them) are in order."""
    change = np.any(keys[1:] != keys[:-1], axis=1)
    bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(values)]])
    sizes = np.diff(bounds)
    first, second = [], []
    group = np.repeat(np.arange(len(sizes)), sizes)
    live = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    for step in range(1, SMALL):
        live = live[live + step < len(values)]
        live = live[group[live + step] == group[live]]
        if not len(live):
            break
        apart = np.bitwise_count(values[live] ^ values[live + step])
        near = live[(apart <= distance) & (apart > 0)]
        first.append(values[near])
        second.append(values[near + step])
    for i in np.flatnonzero(sizes > SMALL):
        a, b = _search(values[bounds[i] : bounds[i + 1]], distance)
        first.append(a)
        second.append(b)
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints; enough of them to connect all that link."""
    how = plan(prints.count(), bit_counts(prints), distance)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            for buckets, own in probes(values, how):
                yield pa.RecordBatch.from_arrays([pa.array(buckets.view(np.int64)), pa.array(own.view(np.int64))], names=["bucket", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            last = np.any(rows[:, :3] != rows[-1, :3], axis=1)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last bucket may go on
            yield linked(rows[:cut])
            held = rows[cut:]
        if held is not None:
            yield linked(held)

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        a, b = links_of(rows[:, :3], np.ascontiguousarray(rows[:, 3]).view(np.uint64), distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    probed = prints.select("fp").mapInArrow(probe, "bucket bigint, fp bigint")
    large = probed.groupBy("bucket").count().filter(F.col("count") > MOST)
    large = large.select("bucket", F.ceil(F.col("count") / MOST).cast("int").alias("k"))
    block = F.pmod(F.xxhash64("fp"), F.coalesce("k", F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1), lambda c: F.struct(F.least(block, c).cast("bigint").alias("x"), F.greatest(block, c).cast("bigint").alias("y")))
    dealt = probed.join(large, "bucket", "left").select("bucket", "fp", F.explode(pairs).alias("p"))
    dealt = dealt.select("bucket", "p.x", "p.y", "fp").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    return dealt.mapInArrow(verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), a row for every row of ``docs``; root: a fingerprint."""
    small_batches(docs.sparkSession)
    seen = stage(docs.select("doc_id", text_key().alias("text_key"), fingerprints_of(shingle)("text").alias("fp")), "fingerprints")
    prints = stage(seen.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    linked = components(near_links(prints, distance)).withColumnRenamed("id", "fp")
    rooted = prints.join(linked, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return seen.join(rooted.select("fp", "root").join(smallest, "root"), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, one for each component.

    A component without a doc_id that is not null keeps the row of the smallest text key.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_key")
    rows = wrapped(docs)
    return rows.join(kept, same(rows, kept, "doc_id", "text_key"), "left_semi").dropDuplicates(["doc_id", "text_key"]).select("doc.*")


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

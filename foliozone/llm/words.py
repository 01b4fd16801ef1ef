"""Words of many texts at once: positions and 64-bit names in NumPy arrays, straight from Arrow buffers.

A batch of texts is cut into blocks of whole texts of about ``BLOCK`` bytes, so that the arrays of
a task stay small whatever the batch holds; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 2 << 20

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TAKE = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags; the bytes of the given closed spans are set."""
    table = np.zeros(256, dtype=bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``: all but ASCII white space.
PLAIN = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased: digits, letters, all beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole value; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for two names in this order."""
    return mix(a * _M1 + mix(b + _M1))


def follow(names: np.ndarray, n: int) -> np.ndarray:
    """A name for every run of ``n`` consecutive names, by doubling; ends of texts are not seen here."""
    m = len(names) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out, at, power, size = None, 0, names, 1
    while True:
        if n & size:
            part = power[at : at + m]
            out = part.copy() if out is None else pair(out, part)
            at += size
        if 2 * size > n:
            return out
        power, size = pair(power[:-size], power[size:]), 2 * size


@dataclass
class Block:
    """Whole texts ``first..last`` of a batch and their words."""

    first: int
    last: int
    data: np.ndarray  # bytes of all texts of the block
    offsets: np.ndarray  # where each text starts in data, and the end of the last
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    bounds: np.ndarray  # of texts in words: text i has the words bounds[i]..bounds[i+1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def names(self) -> np.ndarray:
        """A 64-bit name for every word, from its bytes alone."""
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
        size = self.ends - self.starts
        out = mix(size.astype(np.uint64) + _M1)
        live, at = np.arange(len(size)), self.starts
        while len(live):
            left = size[live]
            piece = np.ascontiguousarray(eights[at]).view(np.uint64).ravel() & _TAKE[np.minimum(left, 8)]
            out[live] = mix((out[live] ^ piece) * _M1)
            more = left > 8
            if not more.any():
                break
            live, at = live[more], at[more] + 8
            size[live] -= 8
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their offsets; a null has none."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.uint8)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return at.astype(np.int64), np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)


def cuts(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, each of a row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def blocks(texts: pa.Array, kind: np.ndarray, lower: bool = False, limit: int = BLOCK) -> Iterator[Block]:
    """The texts in blocks, with their words: the longest runs of bytes of ``kind``."""
    at, data = raw(texts)
    for lo, hi in cuts(at, limit):
        part, offsets = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        if lower:
            part = LOWER[part]
        word = kind[part]
        before, after = np.empty_like(word), np.empty_like(word)
        if len(word):
            before[0] = after[-1] = False
            before[1:], after[:-1] = word[:-1], word[1:]
            inner = offsets[1:-1]
            before[inner[inner < len(word)]] = False
            after[inner[inner > 0] - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        yield Block(lo, hi, part, offsets, starts, ends, np.searchsorted(starts, offsets))


def int_lists(rows: pa.Array) -> list[list[int]]:
    """An Arrow list column of integers as Python lists, by way of one flat array; a null is empty."""
    flat = rows.flatten().to_numpy(zero_copy_only=False).tolist()
    sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def nested(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list for every row, of the given sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))

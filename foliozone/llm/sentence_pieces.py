"""SentencePiece encoding by sampling, and lossless decoding.

A segmentation is drawn from the lattice of all pieces that match the text: forward filtering sums
the weights of all ways to reach each place, backward sampling then draws a way from the end. The
random numbers are hashes of the row's key, the chunk's number and the step, so a row gets the same
pieces wherever and whenever it is encoded. Pieces weigh ``(rank + 2) ** -alpha``: this vocabulary
is ordered by merges; the larger ``alpha``, the fewer pieces and the less variety.

No piece crosses two characters that stand together in no piece, so the lattice falls into chunks
(words, mostly) that are drawn independently. The forward pass runs once for every different chunk
of a block of text, over all chunks at once, place by place; the backward pass over all places where
chunks occur.

A space is written as U+2581, one before the text as the library does. A U+2581 of the text, line
ends and all characters that are no piece go to byte pieces, and nothing is normalised: decoding
gives back every text exactly. Null and empty texts have no pieces and decode to an empty text.
Repeated rows get equal results; rows of equal text but other keys differ. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import small_batches
from foliozone.llm.words import cuts, int_lists, mix, nested, raw

MODEL, ALPHA, SEED = "piece_bpe_32k.model", 1.0, 7
PART = 1 << 18
SPACE = 0x2581
_STEP, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_LOADED: dict[tuple[str, float], Vocabulary] = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces by hash of their characters, for each length."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = {i: model.id_to_piece(i) for i in plain}
        self.bytes_of = [b""] * n
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif i in pieces:
                self.bytes_of[i] = pieces[i].replace(chr(SPACE), " ").encode()
        letters = sorted({c for p in pieces.values() for c in p})
        self.number = np.zeros(0x110001, dtype=np.int32)  # 0: stands in no piece; the last is a U+2581 of the text
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.near = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        self.longest = max(map(len, pieces.values()))
        by_size: list[list[tuple[int, int]]] = [[] for _ in range(self.longest + 1)]
        for i, p in pieces.items():
            codes = self.number[[ord(c) for c in p]]
            self.near[codes[:-1], codes[1:]] = True
            by_size[len(p)].append((int(_gram(codes.astype(np.uint64)[None, :])[0]), i))
        first = min(plain)
        self.hashes, self.ids, self.filters = [], [], []
        for rows in by_size:
            rows.sort()
            hashes = np.array([h for h, _ in rows], dtype=np.uint64)
            self.hashes.append(hashes)
            self.ids.append(np.array([i for _, i in rows], dtype=np.int64))
            seen = np.zeros(1 << 18, dtype=bool)
            seen[(hashes >> np.uint64(46)).astype(np.int64)] = True
            self.filters.append(seen)
        weight = (np.arange(n) - first + 2.0).clip(1) ** -alpha
        self.score = np.log(weight / weight[plain].sum())
        self.unknown = self.score[plain].min() - 5.0  # for a character that goes to bytes


def _gram(codes: np.ndarray) -> np.ndarray:
    """A hash of each row of character numbers, as ``pieces_at`` builds them up."""
    out = np.zeros(len(codes), dtype=np.uint64)
    for k in range(codes.shape[1]):
        out = mix((out ^ codes[:, k]) * _STEP + _PLACE)
    return out


def vocabulary(path: str, alpha: float) -> Vocabulary:
    """Once in a worker."""
    if (path, alpha) not in _LOADED:
        _LOADED[path, alpha] = Vocabulary(path, alpha)
    return _LOADED[path, alpha]


def forward(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(shares, ids): for each place after a character, the running shares of the lengths of the
    piece that ends there, and that piece for each length. Chunks stand one after another in ``codes``."""
    total, longest = len(codes), min(v.longest, int(sizes.max()))
    score = np.full((total, longest), -np.inf, dtype=np.float32)
    ids = np.full((total, longest), -1, dtype=np.int32)
    end = np.repeat(starts + sizes, sizes)
    at, gram = np.arange(total), np.zeros(total, dtype=np.uint64)
    for k in range(1, longest + 1):
        live = at + k <= end[at]
        at, gram = at[live], gram[live]
        gram = mix((gram ^ codes[at + k - 1].astype(np.uint64)) * _STEP + _PLACE)
        may = np.flatnonzero(v.filters[k][(gram >> np.uint64(46)).astype(np.int64)])
        if len(may) and len(v.hashes[k]):
            found = np.minimum(np.searchsorted(v.hashes[k], gram[may]), len(v.hashes[k]) - 1)
            exact = v.hashes[k][found] == gram[may]
            last, piece = at[may[exact]] + k - 1, v.ids[k][found[exact]]
            ids[last, k - 1] = piece
            score[last, k - 1] = v.score[piece]
    lost = ids[:, 0] < 0
    score[lost, 0] = v.unknown
    reach = np.empty(total, dtype=np.float32)
    order = np.argsort(-sizes, kind="stable")
    live = len(order)
    ordered = sizes[order]
    for place in range(int(sizes.max())):
        while live and ordered[live - 1] <= place:
            live -= 1
        here = starts[order[:live]] + place
        width = min(place + 1, longest)
        ways = score[here] if width == longest else score[here, :width]
        if place:
            before = here[:, None] - 1 - np.arange(min(place, width))
            ways[:, : before.shape[1]] += reach[before]
        top = ways.max(axis=1)
        ways -= top[:, None]
        sums = np.cumsum(np.exp(ways, out=ways), axis=1, out=ways)
        reach[here] = top + np.log(sums[:, -1])
        sums /= sums[:, -1:].copy()
        if width == longest:
            score[here] = sums
        else:
            score[here, :width] = sums
            score[here, width:] = 1.0
    return score, ids


def sample(chunks: np.ndarray, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, places, pieces) of every occurrence, in order; a piece of -1 is the character at its place.

    ``chunks``: which chunk each occurrence is; ``keys``: its random key.
    """
    here = starts[chunks] + sizes[chunks] - 1
    first = starts[chunks]
    live = np.arange(len(chunks))
    counts = np.zeros(len(chunks), dtype=np.int64)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = shares.shape[1]
    turn = 0
    while len(live):
        at = here[live]
        draw = (mix(keys[live] + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        k = np.minimum((shares[at] <= draw[:, None]).sum(axis=1), width - 1)
        steps.append((live, at - k, ids[at, k]))
        counts[live] += 1
        here[live] = at - k - 1
        live = live[here[live] >= first[live]]
        turn += 1
    ends = np.cumsum(counts)
    places, pieces = np.empty(ends[-1] if len(ends) else 0, dtype=np.int64), np.empty(ends[-1] if len(ends) else 0, dtype=np.int64)
    for turn, (who, where, what) in enumerate(steps):
        slot = ends[who] - 1 - turn
        places[slot], pieces[slot] = where, what
    return counts, places, pieces


def _draw(codes: np.ndarray, points: np.ndarray, owner: np.ndarray, keys: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, numbers of ids for each owner) of texts that stand one after another."""
    cut = np.ones(len(codes), dtype=bool)
    cut[1:] = ~v.near[codes[:-1], codes[1:]] | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(cut)
    sizes = np.diff(np.concatenate([heads, [len(codes)]]))
    # different chunks: by a hash of their characters in order (unknown ones by their code point)
    exact = np.where(codes > 0, codes, points + (1 << 22)).astype(np.uint64)
    place = (np.arange(len(codes)) - np.repeat(heads, sizes)).astype(np.uint64)
    names = mix(np.add.reduceat(mix(exact + place * _PLACE), heads) + sizes.astype(np.uint64))
    _, where, which = np.unique(names, return_index=True, return_inverse=True)
    own_sizes = sizes[where]
    own_starts = np.concatenate([[0], np.cumsum(own_sizes)[:-1]])
    back = np.repeat(heads[where] - own_starts, own_sizes) + np.arange(own_sizes.sum())
    shares, ids = forward(codes[back], own_starts, own_sizes, v)
    text = owner[heads]
    firsts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    number = np.arange(len(heads)) - np.repeat(firsts, np.diff(np.concatenate([firsts, [len(heads)]])))
    seeds = mix(keys[text] + number.astype(np.uint64) * _PLACE)
    counts, places, pieces = sample(which.ravel(), seeds, own_starts, own_sizes, shares, ids)
    holder = np.repeat(text, counts)
    lost = np.flatnonzero(pieces < 0)
    width = np.ones(len(pieces), dtype=np.int64)
    spelled = [chr(SPACE if c == 0x110000 else c).encode("utf-8", "surrogatepass") for c in points[back[places[lost]]].tolist()]
    width[lost] = [len(b) for b in spelled]
    out = np.repeat(pieces, width)
    if len(lost):
        begin = np.concatenate([[0], np.cumsum(width)[:-1]])[lost]
        slots = np.repeat(begin - np.concatenate([[0], np.cumsum(width[lost])[:-1]]), width[lost]) + np.arange(width[lost].sum())
        out[slots] = v.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
    return out, np.bincount(holder, weights=width, minlength=len(keys)).astype(np.int64)


def encode_texts(texts: list[str], keys: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, numbers of ids of each text)."""
    flat = "".join([" " + t if t else "" for t in texts])
    points = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if not len(points):
        return np.empty(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 if t else 0 for t in texts])
    points[points == SPACE] = 0x110000
    points[points == 0x20] = SPACE
    return _draw(v.number[points], points, owner, keys, v)


def decode_ids(ids: list[int], v: Vocabulary) -> str:
    table = v.bytes_of
    return b"".join([table[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    yield from cuts(raw(texts)[0], PART)


def encoded(text: str | Column, key: str | Column, path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> Column:
    """The ids of a sampled segmentation; ``key``: a bigint column that seeds the row."""
    return arrow_udf(_encoder(path or model_path(), alpha, seed), "array<int>")(text, key)


def _encoder(path: str, alpha: float, seed: int):
    def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
        v = vocabulary(path, alpha)
        own = mix(keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(seed))
        ids, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo, hi in _parts(texts):
            got, n = encode_texts([t or "" for t in texts[lo:hi].to_pylist()], own[lo:hi], v)
            ids.append(got)
            sizes.append(n)
        return nested(np.concatenate(ids).astype(np.int32), np.concatenate(sizes), pa.int32())

    return encode


def round_trip(text: str | Column, key: str | Column, path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> Column:
    """A struct of the ids and of whether they decode to the text, both in one call."""
    path = path or model_path()
    encode, decode = _encoder(path, alpha, seed), _decoder(path, alpha)

    def both(texts: pa.Array, keys: pa.Array) -> pa.Array:
        ids = encode(texts, keys)
        return pa.StructArray.from_arrays([ids, pc.equal(decode(ids), texts.fill_null(""))], names=["ids", "lossless"])

    return arrow_udf(both, "struct<ids:array<int>,lossless:boolean>")(text, key)


def decoded(ids: str | Column, path: str | None = None, alpha: float = ALPHA) -> Column:
    """The text of an array of ids."""
    return arrow_udf(_decoder(path or model_path(), alpha), "string")(ids)


def _decoder(path: str, alpha: float):
    def decode(rows: pa.Array) -> pa.Array:
        v = vocabulary(path, alpha)
        return pa.array([decode_ids(ids, v) for ids in int_lists(rows)], pa.string())

    return decode


def encode(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and ``piece_ids``, seeded by the column ``key``."""
    small_batches(docs.sparkSession)
    return docs.withColumn("piece_ids", encoded("text", F.xxhash64(key)))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the query: number and digest of the pieces, and whether they decode to the text."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", round_trip("text", F.xxhash64("doc_id")).alias("r"))
    return rows.select("doc_id", F.size("r.ids").cast("bigint").alias("n_pieces"), F.hex(F.xxhash64("r.ids")).alias("ids_hash"), "r.lossless")

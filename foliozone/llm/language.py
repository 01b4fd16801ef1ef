"""Language identification of mixed text, word by word.

A model holds, for every language of the training rows, log-probabilities of hashed character
n-grams (1 to 4 characters, word ends included) and the scripts its letters come from. A word's
score in a language is the sum over its n-grams. The script of a word's letters narrows the
candidates to the languages that write in it (all of them, if none does). Viterbi's path over a
text's words, with a penalty for every switch of language, labels spans; the text's language is the
one with most letters in its spans.

The path that never leaves the best language is proven optimal for most texts without a search: if
no run of words gains half the penalty in any other language, no switch can pay. The rest are
searched word by word.

Training reads labelled rows whose text hash is under a threshold that makes their expected number
``SAMPLE`` for each language, whole texts; counts are summed in Spark, and the model, of a fixed
size for each language, is what reaches the driver. All statistics of a prediction come from the
text alone.

A text that is null or has no letter is ``und`` with score 0, as is every text if there are no
training rows. Ties go to the first language by name. Repeated rows get equal results, one each;
columns of the input are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from foliozone.llm.tables import small_batches
from foliozone.llm.words import cuts, mix, raw

#: Hashed n-grams of each size; log-probabilities are float32, so a language takes 512 KB.
BITS, SIZES = 15, (1, 2, 3, 4)
SAMPLE = 1_500  # training texts of a language, expected
SWITCH = 12.0  # the cost of a switch, in nats
SMOOTH = 0.5
#: A script belongs to a language if so much of its letters is of it.
SCRIPT_SHARE = 0.02
PART = 1 << 19

#: First code points of script ranges, and their scripts.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "nko"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "canadian"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C00, "other"), (0x2D00, "georgian"),
    (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"), (0x3100, "bopomofo"), (0x3130, "hangul"), (0x3190, "han"),
    (0xA000, "yi"), (0xA640, "cyrillic"), (0xA720, "latin"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x30000, "han"),
]
_NAMES = sorted({name for _, name in SCRIPTS})

_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Once in a worker: whether a code point is a letter, and its script."""
    if not _TABLES:
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        edges = np.array([first for first, _ in SCRIPTS])
        kinds = np.array([_NAMES.index(name) for _, name in SCRIPTS], dtype=np.uint8)
        _TABLES.extend([letter, kinds[np.searchsorted(edges, np.arange(0x110000), side="right") - 1]])
    return _TABLES[0], _TABLES[1]


class Words:
    """The words (runs of letters) of some texts, and the hashed n-grams of each word."""

    def __init__(self, texts: list[str]) -> None:
        letter, script = _tables()
        parts = [t.lower() for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts])
        flat = np.frombuffer(" ".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letter[flat]
        edge = np.diff(np.concatenate([[0], is_letter.view(np.int8), [0]]))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.size = stops - starts
        self.counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
        self.script = script[flat[starts]] if len(starts) else np.empty(0, np.uint8)
        # every word with the separator on both sides: positions of its n-grams follow each other
        inner = np.maximum(flat * is_letter, 1).astype(np.uint64)  # 1: no letter
        self.grams: list[np.ndarray] = []
        self.bounds: list[np.ndarray] = []
        padded = np.concatenate([[np.uint64(1)], inner, [np.uint64(1)] * 4])
        for n in SIZES:
            code = padded[: len(padded) - n + 1].copy()
            for k in range(1, n):
                code = code * np.uint64(0x110003) + padded[k : len(padded) - n + 1 + k]
            hashed = (mix(code + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32)
            # 1-grams: the letters; longer ones: with the separators at both ends, one at least
            first = starts + 1 if n == 1 else starts
            count = self.size if n == 1 else np.maximum(self.size + 3 - n, 1)
            bounds = np.concatenate([[0], np.cumsum(count)])
            at = np.repeat(first - bounds[:-1], count) + np.arange(bounds[-1])
            self.grams.append(hashed[at])
            self.bounds.append(bounds)

    def scores(self, tables: np.ndarray) -> np.ndarray:
        """Word by language: the sum over the word's n-grams; ``tables``: size, gram, language."""
        out = np.zeros((len(self.size), tables.shape[2]))
        if len(self.size):
            for k in range(len(SIZES)):
                out += np.add.reduceat(tables[k][self.grams[k]], self.bounds[k][:-1], axis=0)
        return out


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        """``counts``: language, size, gram; ``scripts``: language, script."""
        self.languages = languages
        rows = counts + SMOOTH
        logs = np.log(rows / rows.sum(axis=2, keepdims=True))
        # longer n-grams overlap: each size counts in part
        self.tables = np.ascontiguousarray((logs / len(SIZES)).transpose(1, 2, 0), dtype=np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        allowed = (share >= SCRIPT_SHARE).T  # script, language
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0.0, -50.0)

    def scores(self, words: Words) -> np.ndarray:
        return words.scores(self.tables) + self.barred[words.script]


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path; a tie goes to the smaller number."""
    best = int(scores.sum(axis=0).argmax())
    gain = np.cumsum(scores - scores[:, [best]], axis=0)
    floor = np.minimum.accumulate(np.concatenate([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
    if (gain - floor).max() < switch / 2:
        return np.full(len(scores), best)
    n = scores.shape[1]
    rows, back = scores.tolist(), []
    value = rows[0]
    for row in rows[1:]:
        top = max(value)
        lead = value.index(top)
        change = top - switch
        back.append([k if value[k] >= change else lead for k in range(n)])
        value = [max(value[k], change) + row[k] for k in range(n)]
    at = value.index(max(value))
    out = [at]
    for step in reversed(back):
        at = step[at]
        out.append(at)
    return np.array(out[::-1])


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, _ = raw(texts)
    for lo, hi in cuts(at, PART):
        yield lo, [t or "" for t in texts[lo:hi].to_pylist()]


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """``rows``: text and lang."""
    small_batches(rows.sparkSession)
    rows = rows.filter("lang is not null and text is not null").select("text", "lang")
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    share = F.lit(0)
    for lang, n in known.items():
        share = F.when(F.col("lang") == lang, F.lit(round(min(1.0, sample / n) * 1_000_000))).otherwise(share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        cells = len(SIZES) << BITS
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                own = grams.setdefault(lang, np.zeros(cells + len(_NAMES), dtype=np.int64))
                for _, texts in _parts(batch.column(0).filter(pa.array(langs == lang))):
                    words = Words(texts)
                    for k, found in enumerate(words.grams):
                        own[k << BITS : (k + 1) << BITS] += np.bincount(found, minlength=1 << BITS)
                    own[cells:] += np.bincount(words.script, weights=words.size, minlength=len(_NAMES)).astype(np.int64)
        for lang, own in grams.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "cell", "n"])

    # a language's cells are a fixed number; sums are made before anything is exchanged
    counts = rows.filter(place < share).mapInArrow(count, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts["lang"].to_pylist()))
    dense = np.zeros((len(languages), (len(SIZES) << BITS) + len(_NAMES)))
    index = {lang: i for i, lang in enumerate(languages)}
    if languages:
        which = np.array([index[x] for x in counts["lang"].to_pylist()])
        dense[which, counts["cell"].to_numpy()] = counts["n"].to_numpy()
    cells = len(SIZES) << BITS
    return Model(languages, dense[:, :cells].reshape(len(languages), len(SIZES), 1 << BITS), dense[:, cells:])


def predict(texts: list[str], model: Model) -> list[dict]:
    """Language, score and spans (first word, end, language) of each text."""
    words = Words(texts)
    found, at = [], 0
    scores = model.scores(words) if model.languages else None
    for count in words.counts.tolist():
        own = slice(at, at + count)
        at += count
        if not count or scores is None:
            found.append({"lang": "und", "score": 0.0, "spans": []})
            continue
        size, path = words.size[own], best_path(scores[own])
        letters = np.bincount(path, weights=size, minlength=len(model.languages))
        best = int(letters.argmax())
        # the share of its spans, and how clear the language is in them for a word on average
        inside = scores[own][path == best]
        mean = inside.mean(axis=0)
        sure = 1.0 / np.exp(mean - mean[best]).sum()
        heads = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]])).tolist()
        spans = [{"first": a, "end": b, "lang": model.languages[path[a]]} for a, b in zip(heads, [*heads[1:], count], strict=True)]
        found.append({"lang": model.languages[best], "score": float(min(1.0, letters[best] / letters.sum() * sure)), "spans": spans})
    return found


def identified(text: str | Column, model: Model) -> Column:
    """A struct of lang, score and spans for a text column."""

    def label(texts: pa.Array) -> pa.Array:
        rows = [row for _, part in _parts(texts) for row in predict(part, model)]
        spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        return pa.array(rows, pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", spans)]))

    return arrow_udf(label, "struct<lang:string,score:double,spans:array<struct<first:bigint,end:bigint,lang:string>>>")(text)


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but those named lang_*, and lang_pred, lang_score and lang_spans."""
    small_batches(docs.sparkSession)
    found = docs.select(*(c for c in docs.columns if not c.startswith("lang_")), identified("text", model).alias("lang_found"))
    return found.withColumns({"lang_pred": F.col("lang_found.lang"), "lang_score": F.col("lang_found.score"), "lang_spans": F.col("lang_found.spans")}).drop("lang_found")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the query, from a model trained on the rows that are not held out."""
    model = train(docs.filter(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))

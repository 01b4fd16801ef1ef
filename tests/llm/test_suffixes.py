"""Suffix-array dedup beside a plain version."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from samples import messy_rows, prose

from foliozone.llm import suffixes


def plain(rows, span):
    """(doc_id, bytes, removed, spans, digest) by looking at every window; texts of one doc_id are one document."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        if (i, text) in out:
            continue
        gone = np.zeros(len(data) + 1, dtype=bool)
        for p in range(len(data) - span + 1):
            window = data[p : p + span]
            if window in seen:
                gone[p : p + span] = True
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone, strict=False) if not g)
        out[i, text] = (i, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return sorted((out[r] for r in rows), key=repr)


def spark_rows(spark, rows, span):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted((tuple(r) for r in suffixes.digest(suffixes.repeated_spans(docs, span)).collect()), key=repr)


def test_lowest_is_the_first_of_the_smallest():
    for width in (1, 2, 3, 7, 16, 51):
        values = np.random.default_rng(width).integers(0, 5, 200).astype(np.uint64)
        want = [k + int(np.argmin(values[k : k + width])) for k in range(len(values) - width + 1)]
        assert suffixes.lowest(values, width).tolist() == want


def test_stretches_cover_all_windows_once_whatever_the_parts(monkeypatch):
    texts = [prose(1, 400), "", None, "x" * 900, prose(2, 2), "ab" * 300, "ü" * 200 + prose(3, 30)]
    whole = suffixes.stretches(pa.array(texts), 40)
    for i, text in enumerate(texts):
        mine = whole.text == i
        covered = [p for a, b in zip(whole.first[mine], whole.last[mine], strict=True) for p in range(a, b + 1)]
        assert covered == list(range(max(0, len((text or "").encode()) - 39)))
    assert ((whole.first <= whole.at) & (whole.at + 20 <= whole.last + 40)).all() and (whole.at >= whole.last).all()
    monkeypatch.setattr(suffixes, "PART", 256)
    cut = suffixes.stretches(pa.array(texts), 40)
    place = lambda s: {(t, p, a, k) for t, f, e, a, k in zip(s.text, s.first, s.last, s.at, s.anchor, strict=True) for p in range(f, e + 1)}
    assert place(whole) == place(cut)


@pytest.mark.parametrize("seed", [1, 2])
def test_small_alphabets_and_edited_copies_equal_the_plain_version(spark, seed):
    r = random.Random(seed)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randrange(0, 90)))) for i in range(40)]
    base = prose(seed, 60)
    for i in range(40, 70):  # copies with a few edits
        text = list(base)
        for _ in range(r.randrange(0, 4)):
            text[r.randrange(len(text))] = r.choice("xyz")
        rows.append((i, "".join(text)[r.randrange(0, 40) :]))
    rows += [(70, "é" * 60), (71, "é" * 25 + "a" + "é" * 25), (72, "abc" * 40), (73, "c" + "abc" * 20), (74, base + base)]
    assert spark_rows(spark, rows, 20) == plain(rows, 20)


def test_messy_rows(spark, messy, empty, clashing):
    # rows of null doc_id are distinct by text; doc_id 5 stands twice with one text
    rows = [(r[0], r[1]) for r in messy_rows()]
    want = plain(rows, suffixes.SPAN)
    got = suffixes.digest(suffixes.repeated_spans(messy))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sorted((tuple(r) for r in suffixes.digest(suffixes.repeated_spans(clashing)).collect()), key=repr) == want
    assert suffixes.repeated_spans(empty).count() == 0


def test_spans_give_the_kept_bytes(spark, messy):
    found = {(r["doc_id"], r["text_key"]): r for r in suffixes.repeated_spans(messy).collect()}
    from foliozone.llm.tables import text_key

    for r in messy.withColumn("k", text_key()).collect():
        got, data = found[r["doc_id"], r["k"]], (r["text"] or "").encode()
        kept, at = b"", 0
        for s in got["spans"]:
            assert at <= s["first"] < s["end"]
            kept, at = kept + data[at : s["first"]], s["end"]
        assert hashlib.sha256(kept + data[at:]).hexdigest() == got["kept_sha256"]

"""Rows for the tests: made-up prose and messy documents."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; they must not meet those of a table.
CLASHING = "text_key string, fp int, keys string, base string, spans int, count int, row int, host string, whole string, items int, _found int, root string"


def prose(seed, n, vocabulary=300):
    r = random.Random(seed)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(1 + i % 7)) for i in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


def messy_rows():
    """Nulls in any column, empty, blank and long texts, ties, repeated rows."""
    long = prose(1, 6000)
    shared = prose(2, 60)
    rows = [
        (1, prose(3, 200), "en", "a"),
        (2, None, "en", "a"),
        (3, "", "de", None),
        (4, " \t\n\x0b\x0c\r ", None, "b"),
        (5, prose(4, 120), "en", "b"),
        (5, prose(4, 120), "en", "b"),
        (6, prose(4, 120), "fr", "a"),
        (None, prose(5, 80) + " " + shared, "en", "a"),
        (None, prose(5, 80) + " " + shared, "en", "a"),
        (None, None, None, None),
        (7, long, "en", "a"),
        (8, "x" * 5000, None, "a"),
        (9, prose(6, 30) + "\n" + shared + "\n" + prose(7, 30), "de", "b"),
        (10, "a b", "en", "b"),
        (11, "naïve 中文 \U0001f600 ▁ café x", "fr", "b"),
        (12, "ab ab " * 400, "en", "a"),
        (13, "w " * 40 + "w", "en", "a"),
        (14, "w " * 36 + "w", "en", "b"),
        (15, prose(4, 120).upper(), "en", "b"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


def same_rows(a, b):
    key = lambda r: repr(r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)

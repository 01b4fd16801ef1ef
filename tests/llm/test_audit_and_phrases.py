"""The filter audit and phrase mining beside plain versions."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
from samples import prose

from foliozone.llm import filter_audit, phrases

# --- filter audit


def plain_audit(docs, labels):
    """Every order replayed document by document."""
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        parts.setdefault(lang or "", []).append((i, {n for n, f in fails.items() if f}))
    out = {}
    for part, rows in parts.items():
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                failing = sum(name in f for _, f in rows)
                total[name] += len(gone)
                out[part, order, step] = (len(left), len(gone), failing - len(gone), sum(f == {name} for _, f in rows), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
        for (p, order, step), figures in list(out.items()):
            if p == part:
                out[p, order, step] = figures[:6] + (total[order[step - 1]],)
    return out


def test_filter_audit_equals_a_replay_of_every_order(spark, messy, clashing):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in messy.collect()]
    rows += [(100 + i, prose(i, 150, 400) + ["", " #x", " ABCDEFGHIJ" * 30][i % 3], ["en", "", None][i % 3]) for i in range(12)]
    rows += [(200 + i, rows[-12 + i][1], "en") for i in range(5)]
    labels = [(1, 1, 0), (1, 0, 1), (5, 0, 1), (2, 1, None), (None, 1, 1), (200, None, 1), (101, 1, 0), (8, 7, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(r[0], r[1], r[2]): tuple(r)[3:] for r in filter_audit.audit(docs, known).collect()}
    assert got == plain_audit(rows, labels) and len(got) == 600 * len({r[2] or "" for r in rows})
    one = filter_audit.audit(messy, known).collect()
    assert sorted(one) == sorted(filter_audit.audit(clashing.withColumnRenamed("fp", "fails").withColumnRenamed("host", "good"), known).collect())


def test_filter_audit_of_nothing(spark, empty, messy):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(empty, none).count() == 0
    assert {r["good_lost"] for r in filter_audit.audit(messy, none).collect()} == {0}


def test_characters_count_by_code_points():
    assert filter_audit.own_fails(b"") == 1
    assert not filter_audit.own_fails(("A" + "é" * 9 + " ").encode() * 100) & 4
    assert filter_audit.own_fails(b"AAbbbbbbbb") & 4
    assert filter_audit.own_fails(b"a|b") & 8


# --- phrases


def plain_phrases(docs, least=30, most=2000):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n, out = {}, Counter(), []
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    for lang, counts in f.items():
        longer = {}
        for g, a in counts.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longer[g[i : i + k]] = max(longer.get(g[i : i + k], 0), a if a >= least else 0)
        rows = []
        for g, a in counts.items():
            if len(g) < 2 or a < least or 100 * longer.get(g, 0) >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))  # noqa: E741
            rows.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, i, g.decode(), -a, l, r, n[lang], -s) for i, (s, a, g, l, r) in enumerate(sorted(rows)[:most], 1)]
    return sorted(out)


def phrase_docs():
    rows = [(prose(i, 300, 12), ["en", "de", None, "und"][i % 4]) for i in range(40)]
    rows += [("The Quick brown\tfox jumps over. the lazy dog\nsat; on, a a a a mat", "en")] * 35
    rows += [("un deux trois quatre cinq six sept huit", "fr")] * 31 + [("é è ê", "fr"), (None, "fr"), ("", None), ("x" * 70000, "en"), ("w " * 500, "es")]
    rows += [("a b c. b c a. c a b", "rg"), ("a b c a b c a b c a", "rg")] * 20  # a closed ring
    return rows


def test_phrases_equal_the_plain_version(spark):
    rows = phrase_docs()
    docs = spark.createDataFrame(rows, "text string, lang string")
    for least, most in ((30, 2000), (30, 7), (3, 50)):
        got = sorted(map(tuple, phrases.mine(docs, least, most).collect()))
        assert got == plain_phrases(rows, least, most) and got


def test_phrases_survive_small_tables_of_words(spark, monkeypatch):
    # a full bit table, sums handed on early: nothing changes
    monkeypatch.setattr(phrases, "HELD", 50)
    rows = phrase_docs()
    words = phrases.word_counts(spark.createDataFrame(rows, "text string, lang string"))
    assert words.agg({"n": "sum"}).first()[0] == sum(r[6] for r in {r[0]: r for r in plain_phrases(rows, 1)}.values())
    assert sorted(map(tuple, phrases.mine(spark.createDataFrame(rows, "text string, lang string")).collect())) == plain_phrases(rows)


def test_no_word_follows_the_last_one_of_a_block(spark):
    # each block of texts ends in two words that are joined: a word after its last one would be a phrase
    names, every = np.array([5, 6, 7], dtype=np.uint64), np.ones(3, dtype=bool)
    columns, n = phrases.edges_of(names, every, np.array([True, True, False]))
    assert sorted(zip(*(c.tolist() for c in columns), n.tolist(), strict=True)) == [(5, 6, 7, 0, 1), (6, 7, 0, 0, 1), (7, 0, 0, 0, 1)]
    rows = [("on the mat", "en"), ("mat mat", "en")] * 29 + [("the cat on the mat", "en")] * 11
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(40)
    for least in (30, 3):
        assert sorted(map(tuple, phrases.mine(docs, least).collect())) == plain_phrases(rows, least)


def test_paths_are_fixed_expressions(spark):
    docs = spark.createDataFrame(phrase_docs(), "text string, lang string")
    words = phrases.word_counts(docs)
    counts = phrases.phrase_counts(docs, words)
    edges = counts.filter("w4 <> 0")
    found = phrases.paths(edges)
    texts = {(r["lang"], r["expression"]): (r["n_words"], r["least"], r["most"]) for r in phrases.expressions(found, words).collect()}
    assert texts["fr", "un deux trois quatre cinq six sept huit"] == (8, 31, 31)
    assert texts["en", "the quick brown fox jumps over"][0] == 6
    # every edge is on one path
    assert sum(len(r["counts"]) for r in found.collect()) == edges.count()


def test_phrases_of_nothing_and_messy_rows(spark, empty, messy, clashing):
    assert phrases.mine(empty).count() == 0
    want = plain_phrases([(r["text"], r["lang"]) for r in messy.collect()])
    assert sorted(map(tuple, phrases.mine(messy).collect())) == want
    assert sorted(map(tuple, phrases.mine(clashing).collect())) == want

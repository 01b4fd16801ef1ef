"""Decontamination, SimHash and substring dedup beside plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from samples import messy_rows, prose, same_rows

from foliozone.llm import components, decontamination, simhash, substrings
from foliozone.llm.words import ALNUM, PLAIN, blocks, follow

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def test_words_are_those_of_the_patterns():
    import pyarrow as pa

    texts = [r[1] for r in messy_rows()] + ["", "A-b c", None, "x"]
    for kind, lower, expected in ((PLAIN, False, plain_words), (ALNUM, True, alnum_words)):
        got = []
        for block in blocks(pa.array(texts), kind, lower, limit=400):
            data = block.data.tobytes()
            words = [data[a:b].decode() for a, b in zip(block.starts, block.ends, strict=True)]
            got += [words[a:b] for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True)]
            names = block.names()
            assert len(set(zip(names.tolist(), words, strict=True))) == len(set(words)) == len(set(names.tolist()))
        assert got == [expected(t) for t in texts]


def test_runs_of_names_depend_on_all_their_names():
    names = np.random.default_rng(0).integers(0, 4, 500).astype(np.uint64)
    for n in (1, 2, 3, 7, 13, 35):
        got = follow(names, n)
        spans = [tuple(names[i : i + n]) for i in range(len(names) - n + 1)]
        assert len(got) == len(spans) and len(set(zip(got.tolist(), spans, strict=True))) == len(set(spans)) == len(set(got.tolist()))


# --- decontamination


def plain_decontamination(docs, items):
    out = []
    windows = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        k = min(13, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows[tuple(words[i : i + k])].add(str(item))
    for doc, text in docs:
        words = alnum_words(text)
        hit, found = set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if own := windows.get(tuple(words[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= own
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def items_of():
    passage = prose(50, 40)
    items = [(1, passage), (2, passage.upper()), (10, prose(51, 13)), (3, "a b"), (4, ""), (5, None), (6, prose(52, 12)), (7, "w w w w"), (10, prose(51, 13)), (8, prose(53, 300))]
    docs = [(r[0], r[1]) for r in messy_rows()]
    docs += [(100, prose(60, 30) + " " + passage + " " + prose(61, 30)), (101, " ".join(passage.split()[20:33]) + " " + prose(62, 400)), (102, " ".join(passage.split()[20:32]) + " tail")]
    docs += [(103, prose(51, 13)), (104, "x " + prose(52, 12) + " y"), (105, "A, B"), (106, (prose(53, 300) + " ") * 3), (107, " ".join(prose(53, 300).split()[5:18]))]
    return docs, items


def test_decontamination_equals_the_plain_version(spark):
    docs, items = items_of()
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = decontamination.digest(decontamination.decontaminate(table, spark.createDataFrame(items, "item_id bigint, text string")))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_decontamination(docs, items)


def test_items_without_an_id_count(spark):
    docs = [(1, prose(80, 20)), (2, prose(80, 20) + " " + prose(81, 20)), (3, prose(82, 20)), (4, prose(83, 20))]
    items = [(None, prose(80, 20)), (None, prose(83, 20)), (None, prose(83, 15)), (7, prose(81, 20)), (None, None)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = decontamination.digest(decontamination.decontaminate(table, spark.createDataFrame(items, "item_id bigint, text string")))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(1, 20, 20, 1, sha(""), True), (2, 40, 40, 2, sha("7"), True), (3, 20, 0, 0, sha(""), False), (4, 20, 20, 1, sha(""), True)]
    assert sorted(map(tuple, got.collect())) == want


def test_decontamination_of_empty_tables(spark, messy, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate(messy, none).filter("n_hit > 0 or contaminated").count() == 0
    assert decontamination.decontaminate(empty, none).count() == 0


def test_every_shared_span_has_a_shared_fingerprint():
    import pyarrow as pa

    for seed in range(30):
        span = prose(seed, 13, 9)
        texts = [f"{prose(seed + 100, 20, 9)} {span} {prose(seed + 200, 20, 9)}", span]
        (block,) = blocks(pa.array(texts), ALNUM, True)
        hashes, owners = decontamination.fingerprints(block, block.names(), ())
        assert set(hashes[owners == 0]) & set(hashes[owners == 1])


# --- SimHash


def plain_fingerprint(text):
    words = plain_words((text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    left, labels = set(range(len(prints))), {}
    while left:
        queue = [min(left)]
        group = set(queue)
        while queue:
            at = queue.pop()
            near = {j for j in left - group if (prints[at] ^ prints[j]).bit_count() <= distance}
            group |= near
            queue += near
        left -= group
        labels |= dict.fromkeys(group, min(group))
    return labels


def test_fingerprints_equal_the_plain_version(spark, messy):
    want = sorted(((r[0], f"{plain_fingerprint(r[1]):016x}") for r in messy_rows()), key=repr)
    got = simhash.digest(simhash.near_duplicates(messy)).select("doc_id", "fingerprint").collect()
    assert sorted(map(tuple, got), key=repr) == want


def cluster_prints(seed, n):
    """Fingerprints in chains and groups, and lone ones."""
    r = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        at = int(r.integers(0, 1 << 63)) * 2 + int(r.integers(0, 2))
        for _ in range(int(r.choice([1, 1, 2, 150]))):
            out.append(at)
            for b in r.choice(64, int(r.integers(0, 6)), replace=False):
                at ^= 1 << int(b)
    return list(dict.fromkeys(out))[:n]


def test_search_finds_all_components(spark, monkeypatch):
    for most in (20_000, 40):
        monkeypatch.setattr(simhash, "MOST", most)  # the second time large buckets are dealt to blocks
        prints = cluster_prints(3, 700)
        table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
        links = simhash.near_links(table)
        roots = {r["id"] % (1 << 64): r["root"] for r in components.components(links).collect()}
        labels = plain_components(prints)
        groups = defaultdict(set)
        for i, p in enumerate(prints):
            groups[labels[i]].add(roots.get(p, p - (1 << 64) if p >> 63 else p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_thresholds_add_up_and_cover():
    counts = lambda n: np.full((64, 64), n / 4) + np.diag(np.full(64, n / 4))
    for n in (10, 10**5, 10**9):
        how = simhash.plan(n, counts(n), 4)
        assert sorted(b for p in how.parts for b in p) == list(range(64))
        assert sum(how.limits) == 4 - len(how.parts) + 1
    assert len(simhash.plan(10**9, counts(10**9), 4).parts) < len(simhash.plan(10**5, counts(10**5), 4).parts)


def test_blank_texts_link_and_the_smallest_id_names_a_component(spark, messy, clashing, empty):
    found = simhash.near_duplicates(messy)
    rows = {(r["doc_id"], r["fp"]): r["component_id"] for r in found.collect()}
    assert {c for (_, fp), c in rows.items() if fp == 0} == {2}
    assert same_rows(found, simhash.near_duplicates(clashing))
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.first_of_each(messy, found)
    assert kept.columns == messy.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 0 and ids[15] == 0 and ids[2] == 1 and ids[3] == 0 and ids[None] == 1


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    got = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- substrings


def plain_substrings(docs, span=35):
    count, out = Counter(), []
    words = [(doc, plain_words(text)) for doc, text in docs]
    for _, w in words:
        count.update(tuple(w[i : i + span]) for i in range(len(w) - span + 1))
    for doc, w in words:
        gone = {p for i in range(len(w) - span + 1) if count[tuple(w[i : i + span])] > 1 for p in range(i, i + span)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings_equal_the_plain_version(spark, messy, clashing):
    docs = [(r[0], r[1]) for r in messy_rows()]
    passage = prose(70, 36).split()
    docs += [(200, " ".join(passage)), (201, " ".join(["x", *passage[:35], "y"])), (202, " ".join(passage[:34])), (203, prose(71, 35)), (204, prose(71, 35)), (205, prose(72, 34)), (206, prose(72, 34))]
    docs += [(207, prose(73, 50, 3)), (208, prose(74, 300, 2)), (209, ("p q r s t u v w x y " * 12)), (210, "z " + ("p q r s t u v w x y " * 4)), (211, " ".join(passage) + " " + " ".join(passage))]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = substrings.digest(substrings.repeated_spans(table))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_substrings(docs)
    assert same_rows(substrings.repeated_spans(messy), substrings.repeated_spans(clashing))


def test_substrings_of_an_empty_table(empty):
    assert substrings.repeated_spans(empty).count() == 0


def test_equal_windows_have_equal_keys_wherever_they_stand():
    import pyarrow as pa

    texts = [prose(80 + i, 90, 4 + i) for i in range(6)]
    texts += [f"{prose(90, 11, 5)} {t} {prose(91, 17, 5)}" for t in texts] + ["r " * 80, "s " + "r " * 50, "a b c d e " * 20]
    seen = {}
    for block in blocks(pa.array(texts), PLAIN):
        names = block.names()
        starts, keys, _, _ = substrings.window_keys(names, block.bounds)
        for p, key in zip(starts, keys, strict=True):
            window = tuple(names[p : p + 35].tolist())
            assert seen.setdefault(window, key) == key


def test_spans_of_windows():
    assert substrings.spans_of([3, 0, 1, 50], 35) == [(0, 38), (50, 85)]
    assert substrings.spans_of([], 35) == []

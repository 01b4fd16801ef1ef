"""Language ID, main text, token counts and pieces, beside plain versions and libraries."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from samples import messy_rows, prose, same_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliozone.llm import language, main_text, sentence_pieces, token_counts

# --- language


def plain_best(scores, switch):
    value = scores[0].copy()
    for row in scores[1:]:
        value = np.maximum(value, value.max() - switch) + row
    return value.max()


def test_best_path_is_optimal():
    r = np.random.default_rng(1)
    for _ in range(400):
        scores = r.normal(size=(int(r.integers(1, 40)), int(r.integers(1, 5)))) * r.choice([0.5, 4])
        path = language.best_path(scores, 5.0)
        got = scores[np.arange(len(path)), path].sum() - 5.0 * (path[1:] != path[:-1]).sum()
        assert abs(got - plain_best(scores, 5.0)) < 1e-9


@pytest.fixture(scope="module")
def model(spark):
    rows = [(prose(1000 + i, 80, 40), "xx") for i in range(60)] + [(prose(3000 + i, 80, 40).upper().translate(str.maketrans("ETAO", "ÖZQK")), "yy") for i in range(60)]
    rows += [("привет мир это язык " * 10, "ru")] * 5 + [(None, "xx"), ("text", None)]
    return language.train(spark.createDataFrame(rows, "text string, lang string"))


def test_scripts_and_spans(model):
    assert model.languages == ["ru", "xx", "yy"]
    a, b = prose(5000, 40, 40), prose(6000, 40, 40).upper().translate(str.maketrans("ETAO", "ÖZQK"))
    found = language.predict([a, b, "мир", a + " " + b, "", "12 34 -", "日本"], model)
    assert [f["lang"] for f in found[:3]] == ["xx", "yy", "ru"]
    spans = found[3]["spans"]
    assert [s["lang"] for s in spans] == ["xx", "yy"] and abs(spans[0]["end"] - len([w for w in a.split()])) <= 2
    assert [f["lang"] for f in found[4:6]] == ["und", "und"] and found[4]["score"] == 0
    assert all(0 <= f["score"] <= 1 for f in found)
    # a text's result does not rest on what stands beside it
    assert language.predict([a], model)[0] == found[0]


def test_language_of_odd_tables(spark, messy, clashing, empty, model):
    rows = {r["doc_id"]: r for r in language.identify(messy, model).collect()}
    assert rows[2]["lang_pred"] == "und" == rows[4]["lang_pred"] and rows[7]["lang_pred"] != "und"
    assert same_rows(language.digest(messy), language.digest(clashing))
    assert language.digest(messy).count() == messy.count()
    assert language.digest(empty).count() == 0
    assert {r["lang_pred"] for r in language.identify(messy, language.train(empty)).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = language.digest(docs).join(docs, "doc_id").filter("held_out")
    assert scored.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# --- main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=/a>a</a><li>b</ul></nav><div class="ad">Buy &amp; save</div>
<article class=post><h1>Head &amp; tail</h1><p><b>One&nbsp;two
 three<br>four<p>Second &lt;b&gt; para</p><aside>Aside</aside><form>Name <input></form><div class="user-comments"><p>I agree with all of this.</div>
<table><tr><td>c1<td>c2</table></article>
<footer>&copy; us</footer></body>"""


def test_an_article_without_its_surroundings():
    assert main_text.main_text(PAGE) == "Head & tail\n\nOne two three four\n\nSecond <b> para\n\nc1\n\nc2"


def test_regions_by_ratio_where_no_article_is_marked():
    long = prose(1, 80)
    links = "".join(f"<li><a href=/{i}><b>l{i}</b></a></li>" for i in range(20))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Title</h2><p>{long}</p><p>Short.</p><p>{long}</p></div><div><span><a>x</a></span></div></body>"
    assert main_text.main_text(page) == f"Title\n\n{long}\n\nShort.\n\n{long}"


def test_short_blocks_stay_whatever_holds_them():
    long = [prose(k, 80) for k in range(4)]
    nav = "<div><ul>" + "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(20)) + "</ul></div>"
    blocks = ["<div><h2>Title</h2></div>", f"<div><p>{long[0]}</p></div>", "<blockquote><p>Short quote.</p></blockquote>", "<table><tr><td>c1</td><td>c2</td></tr></table>", f"<section><p>{long[1]}</p></section>", "<section><p>Brief.</p></section>"]
    want = ["Title", long[0], "Short quote.", "c1", "c2", long[1], "Brief."]
    text = "\n\n".join(want)
    inner = "".join(blocks)
    assert main_text.main_text(f"<body>{inner}</body>") == text
    assert main_text.main_text(f"<body>{nav}<div>{inner}</div>{nav}</body>") == text
    assert main_text.main_text(f"<body>{nav}<div><div><h1>T</h1></div><div><p>{long[2]}</p></div><table><tr><td>x</td></tr></table></div></body>") == f"T\n\n{long[2]}\n\nx"
    assert main_text.main_text("<body>" + "".join(f"<article><p>{t}</p></article>" for t in (long[0], "Short one.", long[1])) + "</body>") == f"{long[0]}\n\nShort one.\n\n{long[1]}"


LONG = [prose(20 + k, 60) for k in range(6)]
PARAS = "".join(f"<p>{t}</p>" for t in LONG[:2])
BOTH = f"{LONG[0]}\n\n{LONG[1]}"
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # labels around all of the text silence nothing
        (f"<form id=aspnetForm>{PARAS}</form>", BOTH),
        (f"<form><label>Search</label><input><div>{PARAS}</div></form>", BOTH),
        (f'<article><div class="elementor-widget wide">{PARAS}</div></article>', BOTH),
        (f'<div class="widget">{PARAS}</div>', BOTH),
        (f'<div class="modal"><div class="notice"><div>{PARAS}</div></div></div>', BOTH),
        (f"<noscript>{PARAS}</noscript>", BOTH),
        (f'<div role="form">{MENU}{PARAS}</div>', BOTH),
        # parts of names are no names
        (f'<div id="content" class="no-sidebar">{PARAS}</div>', BOTH),
        (f'<div class="has-menu loading-ads-off">{PARAS}</div>', BOTH),
        # labels beside the text do
        (f'<div class="site-header">The Site</div><div>{PARAS}</div>', BOTH),
        (f'<div class="site_footer">The Site</div><div>{PARAS}</div>', BOTH),
        (f'<div>{PARAS}</div><div class="comments"><p>{LONG[2]}</p><p>{LONG[3]}</p><p>{LONG[4]}</p></div>', BOTH),
        (f'<div>{PARAS}<div class="cookie-notice"><p>{LONG[2]}</p></div></div>', BOTH),
        (f"<div>{PARAS}</div><aside><p>{LONG[2]}</p></aside>", BOTH),
        (f"<form><input><p>Your name</p></form><div>{PARAS}</div>", BOTH),
        (f'<form>{PARAS}<div class="newsletter"><p>{LONG[2]}</p></div></form>', BOTH),
        # lists of links go wherever they are, a link alone stays
        (f"<main>{MENU}{PARAS}</main>", BOTH),
        (f"<main>{PARAS}{MENU}</main>", BOTH),
        (f"<main><p><a href=/x>Source</a></p>{PARAS}</main>", f"Source\n\n{BOTH}"),
        (f"<div>{MENU}</div><div>{PARAS}</div><div>{MENU}</div>", BOTH),
        # no element of the page's own names the text
        (f"<table><tr><td>{MENU}</td><td>{PARAS}</td></tr></table>", BOTH),
        (f"<section><h1>Head</h1><section>{PARAS}</section></section>", f"Head\n\n{BOTH}"),
        (f"<div>{LONG[0]}<br><br>{LONG[1]}</div>", f"{LONG[0]} {LONG[1]}"),
        (f"<div><blockquote>{LONG[0]}</blockquote><p>Short.</p><p>{LONG[1]}</p></div>", f"{LONG[0]}\n\nShort.\n\n{LONG[1]}"),
        # an article that holds little beside text that holds much does not decide
        (f"<article><p>Teaser</p></article><div>{PARAS}<p>{LONG[2]}</p></div>", f"Teaser\n\n{BOTH}\n\n{LONG[2]}"),
        ("<script>var x = 1;</script><style>p {}</style>", ""),
    ],
)
def test_pages_of_all_kinds(page, want):
    assert main_text.main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == want


def test_deep_nesting_takes_time_by_length():
    import time

    def seconds(n):
        began = time.perf_counter()
        main_text.main_text("<b>" * n + "<ul><li>" * n + "x" + "</i></b>" * n + "<p>y<td>z" * n)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(40_000) < 30 * seconds(4000)


def test_empty_tables_and_clashing_columns(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    assert main_text.extract(spark.createDataFrame([], schema)).count() == 0
    (row,) = main_text.extract(spark.createDataFrame([(1, "u", "<p>x y", "other", 7)], schema)).collect()
    assert tuple(row) == (1, "u", "x y", 3)


@given(st.text(alphabet="<>/abp &;!-='\" \n", max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_markup_is_taken(page):
    text = main_text.main_text(page)
    assert text == text.strip()


def test_pages_of_the_tables_and_odd_ones(spark):
    import html
    import re

    def plain(page):
        inside = page.split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        return "\n\n".join(b for b in parts if b)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in main_text.extract(pages).collect()}
    for r in pages.collect():
        want = plain(r["html"])
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>x"), (2, "u", "<p>x")], "page_id bigint, url string, html string")
    assert sorted((r["text"], r["n_chars"]) for r in main_text.extract(odd).collect()) == [("", 0), ("", 0), ("x", 1), ("x", 1)]


# --- token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_counts.vocabulary("byte_bpe_50k")[0])


POOL = ["'s", "'re", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "1", "23", "!", "<|endoftext|>", " ", "日", "\U0001f600", "'", "S", " ", "\x1c", "\x85", "́", "​"]


def test_counts_equal_the_library(tokenizer, monkeypatch):
    described, ranks = token_counts.vocabulary("byte_bpe_50k")
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    r = random.Random(1)
    texts = [f"a{c}b {c}{c}1{c}" for c in points] + ["".join(r.choice(POOL) for _ in range(r.randint(0, 60))) for _ in range(2000)] + [prose(1, 3000)]
    want = [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_tokens(texts, described, ranks) == want
    monkeypatch.setattr(token_counts.pieces, "__defaults__", (7,))  # cuts at every safe place
    assert token_counts.count_tokens(texts, described, ranks) == want


def test_counts_of_odd_tables(messy, clashing, empty, tokenizer):
    rows = token_counts.count(messy).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False))) for r in messy_rows()), key=repr)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows), key=repr) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert same_rows(token_counts.count(messy), token_counts.count(clashing))
    assert token_counts.count(empty).count() == 0


# --- pieces


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.vocabulary(sentence_pieces.model_path(), 1.0)


def drawn(texts, v, first=0):
    ids, sizes = sentence_pieces.encode_texts(texts, sentence_pieces.mix(np.arange(first, first + len(texts)).astype(np.uint64)), v)
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


@given(st.lists(st.text(max_size=40), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_decoding_is_lossless(texts):
    v = sentence_pieces.vocabulary(sentence_pieces.model_path(), 1.0)
    assert [sentence_pieces.decode_ids(ids, v) for ids in drawn(texts, v)] == texts


def test_the_library_decodes_the_same(pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())
    texts = [prose(i, 50) for i in range(20)] + ["two  spaces\n\U0001f600 é", "a" * 400]
    assert [model.decode(ids) for ids in drawn(texts, pieces)] == texts


def test_draws_follow_the_lattice(pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())

    def ways(s):
        if not s:
            yield ()
        for k in range(1, len(s) + 1):
            if (i := model.piece_to_id(s[:k])) != model.unk_id():
                yield from ((i, *rest) for rest in ways(s[k:]))

    for alpha in (1.0, 0.2):
        v = sentence_pieces.vocabulary(sentence_pieces.model_path(), alpha)
        weights = {w: math.exp(sum(v.score[i] for i in w)) for w in ways("▁token")}
        n, total = 20_000, sum(weights.values())
        got = Counter(map(tuple, drawn(["token"] * n, v)))
        assert set(got) <= set(weights)
        for way, weight in weights.items():
            p = weight / total
            assert abs(got[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_a_row_gets_its_pieces_wherever_it_stands(spark, messy, clashing, empty, pieces):
    texts = [prose(i, 60) for i in range(6)]
    assert drawn(texts, pieces)[3:] == drawn(texts[3:], pieces, 3)
    one, other = sentence_pieces.digest(messy), sentence_pieces.digest(clashing.repartition(3))
    assert same_rows(one, other) and one.filter("not lossless").count() == 0
    assert sentence_pieces.digest(empty).count() == 0

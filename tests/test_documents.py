from datetime import date

from fixtures import ADAPTER, FEB, JAN, NO_ROWS, PROFILE, THREE_ROWS, decision, entry, listing
from pyspark.sql import functions as F

from foliozone.operators import audits
from foliozone.operators import listing as pages
from foliozone.plans import periods
from foliozone.sources import markup


def extract(spark, *rows):
    df = spark.createDataFrame([(i, bytearray(p) if p is not None else None, t) for i, (p, t) in enumerate(rows)], "i INT, payload BINARY, content_type STRING")
    got = ADAPTER.extract(df).orderBy("i").collect()
    return [(bytes(r["payload"]) if r["payload"] is not None else None, r["extract_error"]) for r in got]


def test_extraction_keeps_the_decision_and_drops_the_chrome(spark):
    ((content, error),) = extract(spark, (decision(), "text/html; charset=utf-8"))
    assert error is None
    assert content == (
        b'<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>CASE-0001 - Site</title>\n</head>\n'
        b"<body>\n<h1>Finding</h1><p>The claim is upheld.</p>\n</body>\n</html>\n"
    )


def test_other_types_pass_untouched_and_missing_stays_missing(spark):
    pdf = b"%PDF-1.7 <!-- Elapsed time: 3 --> \xff\x00"
    got = extract(spark, (pdf, "application/pdf"), (b"", "application/pdf"), (None, "text/html"), (b"", "text/html"))
    assert got == [(pdf, None), (b"", None), (None, None), (None, "no decision content container found on page")]


def test_container_rules(spark):
    wrap = '<div class="container mb-4"><div class="row">{}</div></div>'
    blank_then_full = wrap.format('<div class="col-sm-9"> <script>x</script></div><div class="col-sm-9">late</div>')
    only_stripped = wrap.format('<div class="col-sm-9"><header>gone</header></div>')
    got = extract(
        spark,
        (b"<html><body>nothing</body></html>", "text/html"),
        (blank_then_full.encode(), "text/html"),
        (only_stripped.encode(), "text/html"),
    )
    # only the first match of a selector is tested, and it is tested before stripping
    assert got[0][1] and got[1][1]
    assert got[2][1] is None and b"<body>\n\n</body>" in got[2][0]


def test_return_links_are_matched_on_joined_text(spark):
    page = '<div class="container mb-4"><div class="row"><div class="col-sm-9">x<a> RETURN TO SEARCH </a><a>Return <b>to</b> search</a></div></div></div>'
    ((content, _),) = extract(spark, (page.encode(), "text/html"))
    assert b"RETURN" not in content and b"<a>Return <b>to</b> search</a>" in content


def test_charsets_and_escapes(spark):
    body = '<div class="container mb-4"><div class="row"><div class="col-sm-9">caf\xe9 &lt;b&gt; &amp; <img alt="a&quot;b"><br></div></div></div>'
    title = "<title>A &amp; <i>B</i></title>"
    latin = f'<meta charset="iso-8859-1">{title}{body}'.encode("latin-1")
    undeclared = body.encode("cp1252")
    got = extract(spark, (latin, "text/html"), (undeclared, "text/html"))
    for content, error in got:
        assert error is None
        assert "caf\xe9 &lt;b&gt; &amp; <img alt='a\"b'/><br/>".encode() in content


def test_broken_markup_nests_and_nothing_is_lost():
    root = markup.parse(b"<div><p>one<p>two</div></span>three<b>four")
    assert root.inner_html() == "<div><p>one<p>two</p></p></div>three<b>four</b>"
    assert markup.parse(b"<p>a</p> \n <p>b</p>").inner_html() == "<p>a</p>\n<p>b</p>"
    deep = markup.parse(b"<p>" * 5000 + b"x")
    assert deep.stripped_text() == "x" and deep.inner_html().count("</p>") == 5000


def test_selectors():
    root = markup.parse(b'<div class="a b"><ul><li id="k"><a href="">x</a><a>y</a></li></ul></div>')
    find = lambda s: [n.name for n in markup.select(root, markup.compile_selector(s))]
    assert find("div.b.a li a") == ["a", "a"] and find("li#k a[href]") == ["a"] and find(".a .a") == [] and find("ul div") == []


def test_plain_tokens_give_the_tree_of_the_library():
    import random

    def tree(node):
        return (node.name, node.attrs, [tree(c) if isinstance(c, markup.Element) else c for c in node.children])

    def by_library(page):
        builder = markup._Builder()
        builder.feed(page)
        builder.close()
        builder.flush()
        return tree(builder.root)

    bits = ["<p>", "</p>", '<div class=" a  b ">', "</div>", "<br>", "<br/>", '<img alt="a&amp;b">', '<a href="x" href="y">', "<a href=x>", "<a b>", '</a b="c">', "<P>", "</ p>", "</>", "text", " ", "\n", "&amp;", "&lt", "<", ">"]
    bits += ["<!-- c -->", "<!---->", "<!-->", "<!-- a -- b -->", "<!--a-- >", "<!DOCTYPE html>", "<!x>", "<?pi?>", "<![CDATA[x]]>", "<script>", "</script>", "<script>a&amp;b</script>", '<script>a<b "</p>"</script>', "<script/>", "<style></style>", "<title>A &amp; B</title>", "<title><i>", "<pre> </pre>", "<template>x</template>", '<a href="x']
    r = random.Random(3)
    for _ in range(5000):
        page = "".join(r.choice(bits) for _ in range(r.randint(1, 9)))
        assert tree(markup.parse(page.encode())) == by_library(page), page


def test_a_plain_page_needs_no_tolerant_parser(monkeypatch):
    left = []
    monkeypatch.setattr(markup._Builder, "feed", lambda self, rest: left.append(rest))
    markup.parse(listing(entry("X/1", "/x"), "<!-- c --><script>a</script><br/>") + b" end")
    assert left == [" end"]


def test_one_walk_finds_what_single_walks_find():
    page = markup.parse(b'<ul><li class="x"><b>1</b><i>2</i><b>3</b></li><li><i class="k">4</i></li></ul>')
    several = [markup.compile_selector(s) for s in ("b", "i.k", "li.x i", "u", ".k")]
    for root in (page, *markup.select(page, several[0])):
        assert markup.select_firsts(root, several) == [markup.select_one(root, steps) for steps in several]


def test_python_holds_few_pages_at_once(spark):
    import pyarrow as pa

    from foliozone import session

    payloads = [b"x" * 3_000_000, None, b"y" * 3_000_000, b"", b"z" * 3_000_000, b"w" * 20_000_000, b"v"] + [b"u"] * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(payloads))), pa.array(payloads, pa.binary())], names=["i", "payload"])
    cut = list(session.pieces([batch, batch.slice(0, 0)], 1))
    assert pa.Table.from_batches(cut) == pa.Table.from_batches([batch])
    assert [len(b) for b in cut] == [4, 1, 1, 256, 256, 256, 233]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        rows = spark.createDataFrame([(0, bytearray(decision()), "text/html")], "i INT, payload BINARY, content_type STRING")
        ADAPTER.extract(rows)
        assert spark.conf.get(key) == "256"
        spark.conf.set(key, "10000")
        ADAPTER.listing_rows(rows.selectExpr("1L AS cell_seq", "1 AS page_number", "payload"))
        assert spark.conf.get(key) == "256"
    finally:
        spark.conf.set(key, usual)


def read(spark, *payloads):
    df = spark.createDataFrame(
        [(0, i + 1, bytearray(p) if p is not None else None) for i, p in enumerate(payloads)],
        "cell_seq BIGINT, page_number INT, payload BINARY",
    )
    cells = periods.plan_cells(spark, ADAPTER, JAN, FEB)
    found = ADAPTER.listing_rows(df)
    return found, pages.listing_records(found, cells, ADAPTER).orderBy("item_seq").collect()


def test_listing_rows(spark):
    found, rows = read(spark, THREE_ROWS, NO_ROWS)
    assert [r["identifier"] for r in rows] == ["CASE-0001", "AB - C - 0002", "CASE-0003"]
    first = rows[0]
    # the date comes from the row although the url says february
    assert first["decision_date"] == date(2024, 1, 31) and first["partition_date"] == "2024-01"
    assert first["document_url"] == "https://site.example/en/cases/2024/february/case-0001.html"
    assert first["description"] == "A v B" and first["body_name"] == "First Tribunal"
    assert all(r["reject_reason"] is None for r in rows)
    assert [tuple(r) for r in pages.listing_totals(found).collect()] == [(0, 3)]


def test_rejects_and_fallbacks(spark):
    page = listing(
        entry("A", None),
        entry("B", "/b.html", None),
        entry("C", "/c.html", "31/02/2024"),
        entry("D", "https://other/d.pdf", title="D  <b>x</b>", reference=False, description=None),
        entry("", "/e.html", title="E"),
    )
    _, rows = read(spark, page)
    assert [r["reject_reason"] for r in rows[:3]] == [pages.INCOMPLETE, pages.INCOMPLETE, pages.BAD_DATE]
    assert (rows[3]["identifier"], rows[3]["title"], rows[3]["description"]) == ("D x", "D x", "")
    assert (rows[3]["document_url"], rows[3]["content_type"]) == ("https://other/d.pdf", "application/pdf")
    # a reference that is there but empty is still the identifier
    assert (rows[4]["identifier"], rows[4]["title"]) == ("", "E")


def test_chain_stops_at_the_first_empty_or_unread_page(spark):
    rows = [
        (0, 1, False), (0, 2, False), (0, 3, True), (0, 4, False),
        (1, 1, True), (1, 2, False),
        (2, 1, False), (2, 3, False),
        (3, 2, False),
        (4, 1, False),
    ]
    df = spark.createDataFrame(rows, "cell_seq BIGINT, page_number INT, stop BOOLEAN")
    kept = sorted((r["cell_seq"], r["page_number"]) for r in pages.trim_chain(df, F.col("stop")).collect())
    assert kept == [(0, 1), (0, 2), (0, 3), (1, 1), (2, 1), (4, 1)]


def test_catalogue_drift_from_a_captured_panel(spark):
    def panel(*bodies):
        boxes = "".join(f'<input type="checkbox" value="{i}" id="b{i}"><label for="b{i}"> {n} </label>' for i, n in bodies)
        return f'<label for="q">Year</label><label for="g"> Body </label><span id="g">{boxes}</span>'.encode()

    df = spark.createDataFrame([(bytearray(panel(("101", "First Tribunal"), ("102", "Renamed"), ("109", "New"))),)], "payload BINARY")
    seen = audits.observed_bodies(df, PROFILE)
    known = spark.createDataFrame([(b.external_id, b.name) for b in PROFILE.bodies], "external_id STRING, name STRING")
    status = {r["external_id"]: r["status"] for r in audits.catalogue_drift(known, seen.filter("found")).collect()}
    assert status == {"101": "same", "102": "renamed", "103": "removed", "104": "removed", "109": "added"}
    changed = spark.createDataFrame([(bytearray(b"<html>no panel</html>"),)], "payload BINARY")
    assert [r["found"] for r in audits.observed_bodies(changed, PROFILE).collect()] == [False]


def test_marks_and_xml_declarations_name_the_charset():
    from foliozone.sources import markup

    for name in ("utf-16", "utf-32", "utf-8-sig", "utf-16-be", "utf-32-be"):
        text = "<p>caf\u00e9</p>"
        mark = "\ufeff" if name.endswith("-be") else ""
        assert markup.decode((mark + text).encode(name)) == text
    page = '<?xml version="1.0" encoding="iso-8859-2"?><p>\u0159</p>'
    assert markup.decode(page.encode("iso-8859-2")) == page

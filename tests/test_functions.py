import hashlib
import re
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliozone.functions import dates, hashing, keys, text


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, v {kind}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_dates_in_the_three_shapes_and_nothing_else(spark):
    good = ["31/01/2024", "2024-01-31", "31-01-2024", " \t31/1/2024\xa0\n", "1/2/2024", "2024-2- 1", "0001-01-01"]
    bad = ["2024/01/31", "31/02/2024", "31.01.2024", "", "31/01/24", "31/13/2024", "0/1/2024", "0000-01-01", "31/01/2024 x", "2024-01", "2024-01-31T00:00"]
    expected = [date(2024, 1, 31)] * 4 + [date(2024, 2, 1), date(2024, 2, 1), date(1, 1, 1)]
    assert apply(spark, dates.parse_date, good) == expected
    assert apply(spark, dates.parse_date, bad + [None]) == [None] * (len(bad) + 1)


def test_date_shapes_agree_with_strptime(spark):
    def replay(raw):
        for shape in ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y"):
            try:
                return datetime.strptime(raw.strip(), shape).date()
            except ValueError:
                pass
        return None

    raws = [
        f"{a}{s}{b}{s}{c}"
        for s in "/-"
        for a in ("1", "01", "31", "32", "2024", "0", " 7")
        for b in ("2", "02", "12", "13", "0")
        for c in ("2024", "29", "5", "05", " 5", "31", "999")
    ]
    assert apply(spark, dates.parse_date, raws) == [replay(r) for r in raws]


def test_periods_and_labels(spark):
    day = [date(2021, 1, 1), date(2024, 12, 31), date(2024, 2, 29)]
    assert apply(spark, lambda c: dates.period_label(c, "weekly"), day, "date") == ["2020-W53", "2025-W01", "2024-W09"]
    assert apply(spark, lambda c: dates.period_label(c, "monthly"), day, "date") == ["2021-01", "2024-12", "2024-02"]
    assert apply(spark, lambda c: dates.period_label(c, "daily"), day, "date") == ["2021-01-01", "2024-12-31", "2024-02-29"]
    assert apply(spark, dates.last_included_day, [date(2024, 3, 1)], "date") == [date(2024, 2, 29)]
    assert apply(spark, dates.format_site_date, [date(2024, 3, 1)], "date") == ["01/03/2024"]
    assert apply(spark, lambda c: dates.from_utc_midnight(dates.utc_midnight(c)), day, "date") == day
    with pytest.raises(ValueError, match="periods are"):
        dates.period_label(F.col("v"), "yearly")


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ é\t\r\n\f\v\xa0\x1c\x1f\x85 　'\\-9", max_size=12), min_size=40, max_size=60))
def test_text_columns_agree_with_python(spark, values):
    assert apply(spark, text.collapse_whitespace, values) == [re.sub(r"[ \t\r\f\v]+", " ", v).strip() for v in values]
    assert apply(spark, text.collapse_blank_lines, values) == [re.sub(r"\n{3,}", "\n\n", v) for v in values]
    assert apply(spark, text.slugify_identifier, values) == [re.sub(r"[^a-z0-9]+", "-", v.lower()).strip("-") for v in values]
    assert apply(spark, text.remove_whitespace, values) == [re.sub(r"\s+", "", v) for v in values]


def test_quoting_in_messages(spark):
    values = ["a", "it's", 'both \' and "', "back\\slash"]
    assert apply(spark, text.quoted, values) == [repr(v) for v in values]


def test_reported_total(spark):
    values = ["3 results", "1,234 Results", "1 result", "no", "12\n results 4 results", ", results", "x7 RESULTS"]
    assert apply(spark, text.reported_total, values) == [3, 1234, None, None, 12, None, 7]


def test_names_and_keys(spark):
    rows = [
        # url, identifier, landing name
        ("https://s/en/a-1.html", "A 1", "a-1.html"),
        ("https://s/en/a-1.PDF?x=1", "A 1", "a-1.PDF"),
        ("https://s/en/a", "A 1 b", "A1 b.html"),
        ("https://s/en/a.pdf?next=/b", "A 1", "A1.html"),
        ("https://s/en/a.html#frag", "A 1", "a.html#frag"),
    ]
    df = spark.createDataFrame(rows, "url STRING, id STRING, name STRING")
    got = df.select(keys.landing_filename(F.col("url"), F.col("id")).alias("g"), "name").collect()
    assert [r["g"] for r in got] == [r["name"] for r in got]
    curated = df.select(keys.curated_filename(F.col("id"), F.col("url")).alias("g")).collect()
    assert [r["g"] for r in curated] == ["A1.html", "A1.pdf?x=1", "A1b.html", "A1.html", "A1.html#frag"]
    assert apply(spark, keys.path_extension, ["a/b.PDF", "a.b/c", "c"]) == ["pdf", "html", "html"]
    urls = ["/x.pdf", "/x.rtf", "/x.docx", "/x.pdf?a=1", "/x", "/x.HTML", "/x.zip"]
    assert apply(spark, keys.guess_content_type, urls) == [
        "application/pdf",
        "application/rtf",
        "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        "text/html",
        "text/html",
        "text/html",
        "text/html",
    ]
    types = [" Text/HTML ; charset=utf-8", "application/xhtml+xml", "application/pdf", "", None]
    assert apply(spark, keys.is_html, types) == [True, True, False, False, False]
    assert apply(spark, lambda c: keys.extension_for(c, F.lit("/a/b.DOC")), ["text/rtf; x", "image/png"]) == ["rtf", "doc"]
    assert apply(spark, lambda c: keys.absolute_url(c, "https://s"), ["/a", "http://b", "httpx", ""]) == [
        "https://s/a", "http://b", "httpx", "https://s"
    ]
    assert apply(spark, lambda c: keys.served_content_type(c, F.lit("g")), ["", None, "a/b"]) == ["g", "g", "a/b"]
    assert apply(spark, keys.path_only, ["file:/a/b", "file:///a/b", "/a/b", "s3://x/y"]) == ["/a/b", "/a/b", "/a/b", "s3://x/y"]
    assert apply(spark, keys.key_filename, ["a/b/c.html"]) == ["c.html"]


def test_hashes(spark):
    raw = [b"", b"abc", bytes(range(256))]
    assert apply(spark, hashing.content_hash, [bytearray(b) for b in raw], "binary") == [
        "sha256:" + hashlib.sha256(b).hexdigest() for b in raw
    ]
    assert apply(spark, hashing.parse_hash, ["sha256:ab", "ab", "", None]) == ["sha256:ab", None, None, None]
    assert apply(spark, lambda c: hashing.comparison_fingerprint(c, F.lit("f:1")), ["a:2", "", None]) == ["a:2", "f:1", "f:1"]


def test_markers_are_cut_from_bytes_exactly(spark):
    pattern = (r"<!--\s*Elapsed time:[^>]*-->",)
    raw = [
        b"\xff\xfe<p>\x80<!-- Elapsed time: 0.1 --></p>\x00",
        b"<!--Elapsed time: 1--><!--\n Elapsed time: 2 -->x",
        b"Elapsed time: 3",
    ]
    cut = [re.sub(rb"<!--\s*Elapsed time:[^>]*-->", b"", b) for b in raw]
    got = apply(spark, lambda c: hashing.without_markers(c, pattern), [bytearray(b) for b in raw], "binary")
    assert [bytes(b) for b in got] == cut

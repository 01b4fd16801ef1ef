"""Small captured pages in the shape the default profile reads. Text is our own."""

from datetime import date, datetime

from foliozone.sources.adapter import Body, SiteProfile, SourceAdapter

PROFILE = SiteProfile(
    source_name="example_source",
    site_root="https://site.example",
    bodies=(
        Body("first", "First Tribunal", "101"),
        Body("second", "Second Tribunal", "102"),
        Body("third", "Third Tribunal", "103"),
        Body("fourth", "Fourth Tribunal", "104"),
    ),
)
ADAPTER = SourceAdapter(PROFILE)
JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)
RUN_TS = datetime(2024, 6, 1, 12, 0, 0)


def entry(identifier, href, day="31/01/2024", description="A v B", title=None, reference=True):
    ref = f'<div><span>Ref:</span><span class="refNO">{identifier}</span></div>' if reference else ""
    desc = f'<p class="description x">{description}</p>' if description is not None else ""
    link = f'<h2 class="title"><a href="{href}">{title or identifier}</a></h2>' if href is not None else ""
    when = f'<span class="date"> {day} </span>' if day is not None else ""
    return f'<li class="each-item clearfix"><div class="row">{link}{when}</div>{desc}{ref}</li>'


def listing(*entries, total="3 results"):
    return f"<html><head><title>Find</title></head><body><p>{total}</p><ul>{''.join(entries)}</ul></body></html>".encode()


THREE_ROWS = listing(
    entry("CASE-0001", "/en/cases/2024/february/case-0001.html"),
    entry("AB - C - 0002", "/en/cases/2024/january/ab-c-0002.html", "30/01/2024"),
    entry("CASE-0003", "/en/cases/2024/january/case-0003.html", "15/01/2024"),
)
NO_ROWS = listing(total="0 results")


def decision(body="The claim is upheld.", elapsed="0", title="CASE-0001 - Site"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title></head><body>"
        '<div id="bar" class="cookie">We use cookies</div><header>Top menu</header>'
        '<div class="container mb-4"><div class="container"><div class="row">'
        '<div class="col-sm-3"><a class="return-to-search" href="/x">Return to Search</a></div>'
        f'<div class="col-sm-9"><h1>Finding</h1><p>{body}</p><script>var counter = 1;</script>'
        '<a href="/y"> Return to Search </a><div class="no-print">Print me</div></div>'
        f"</div></div></div><footer>Privacy</footer><!-- Elapsed time: {elapsed} --></body></html>"
    ).encode()

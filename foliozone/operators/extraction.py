"""Content extraction over page tables: HTML goes through Python once, the rest stays in the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliozone.functions import keys
from foliozone.session import pieces, small_batches
from foliozone.sources import markup

# Fixed value: the reason of a page without content.
NO_CONTAINER = "no decision content container found on page"


def _clean(payload: bytes, containers, stripped, return_text: str, template: str) -> bytes | None:
    page = markup.parse(payload)
    firsts = (markup.select_one(page, steps) for steps in containers)
    content = next((node for node in firsts if node is not None and node.stripped_text()), None)
    if content is None:
        return None
    for node in [n for n in content.walk() if any(markup.matches(n, steps) for steps in stripped)]:
        node.remove()
    for anchor in [n for n in content.walk() if n.name == "a"]:
        if anchor.stripped_text().lower() == return_text:
            anchor.remove()
    title = next((n for n in page.walk() if n.name == "title"), None)
    filled = template.replace("{title}", title.stripped_text() if title else "", 1)
    head, tail = filled.rsplit("{content}", 1)
    return (head + content.inner_html() + tail).encode("utf-8")


def extract_content(documents: DataFrame, profile, html: Column | None = None) -> DataFrame:
    """Replace ``payload`` by its relevant content and add ``extract_error``.

    Non-HTML rows pass through unchanged and never enter a Python worker. Every other column
    travels along as Arrow buffers, untouched. A null payload stays null without an error.

    ``html`` says which rows to clean and defaults to a test of ``content_type``. Over stored
    objects it is a test of a directory column, so the two branches read different files.
    """
    if html is None:
        html = keys.is_html(F.col("content_type"))
    fields = documents.schema.fields
    schema = T.StructType([*fields, T.StructField("extract_error", T.StringType())])
    column = documents.columns.index("payload")
    containers, stripped = profile.content_selectors, profile.strip_selectors
    return_text, template = profile.return_link_text, profile.curated_template

    def clean(batches):
        inside = [markup.compile_selector(s) for s in containers]
        outside = [markup.compile_selector(s) for s in stripped]
        for batch in pieces(batches, column):
            cleaned = [
                None if p is None else _clean(p, inside, outside, return_text, template)
                for p in (payload.as_py() for payload in batch.column(column))
            ]
            errors = [
                NO_CONTAINER if c is None and p else None
                for c, p in zip(cleaned, batch.column(column).is_valid().to_pylist())
            ]
            arrays = [*batch.columns, pa.array(errors, pa.string())]
            arrays[column] = pa.array(cleaned, pa.binary())
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    small_batches(documents.sparkSession)
    return (
        documents.filter(html)
        .mapInArrow(clean, schema)
        .unionByName(documents.filter(~html).withColumn("extract_error", F.lit(None).cast("string")))
    )

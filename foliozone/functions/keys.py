"""Urls, content types, file names, storage ids and object keys, as columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliozone.functions.text import remove_whitespace, strip

# Media types with a known extension, the one each extension stands for, and those read as HTML.
EXTENSION_BY_CONTENT_TYPE = {
    "text/html": "html",
    "application/xhtml+xml": "html",
    "application/pdf": "pdf",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/rtf": "rtf",
    "text/rtf": "rtf",
}
CONTENT_TYPE_BY_EXTENSION = {
    "html": "text/html",
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "rtf": "application/rtf",
}
HTML_CONTENT_TYPES = ("text/html", "application/xhtml+xml")
DEFAULT_CONTENT_TYPE = "text/html"
DEFAULT_EXTENSION = "html"


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(v) for v in chain.from_iterable(pairs.items())))


def _tail(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _tail_extension(path: Column) -> Column:
    """Lower-cased part after the last dot of the last path segment; null without a dot."""
    tail = _tail(path)
    return F.when(F.contains(tail, F.lit(".")), F.lower(F.substring_index(tail, ".", -1)))


def media_type(content_type: Column) -> Column:
    return F.lower(strip(F.substring_index(content_type, ";", 1)))


def is_html(content_type: Column) -> Column:
    return F.coalesce(media_type(content_type).isin(*HTML_CONTENT_TYPES), F.lit(False))


def path_extension(path: Column) -> Column:
    return F.coalesce(_tail_extension(path), F.lit(DEFAULT_EXTENSION))


def extension_for(content_type: Column, url: Column) -> Column:
    """Extension by served media type, else by url."""
    known = F.try_element_at(_literal_map(EXTENSION_BY_CONTENT_TYPE), media_type(content_type))
    return F.coalesce(known, path_extension(url))


def guess_content_type(url: Column) -> Column:
    """Media type by url extension."""
    known = F.try_element_at(_literal_map(CONTENT_TYPE_BY_EXTENSION), _tail_extension(url))
    return F.coalesce(known, F.lit(DEFAULT_CONTENT_TYPE))


def served_content_type(served: Column, guessed: Column) -> Column:
    return F.coalesce(F.nullif(served, F.lit("")), guessed)


def absolute_url(href: Column, site_root: str) -> Column:
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(site_root), href))


def storage_id(body_code: Column, identifier: Column) -> Column:
    return F.concat(body_code, F.lit(":"), identifier)


def landing_filename(document_url: Column, identifier: Column) -> Column:
    """The site's own file name; only a name without a dot is replaced by the identifier."""
    tail = F.substring_index(_tail(document_url), "?", 1)
    named = F.concat(F.replace(identifier, F.lit(" "), F.lit("")), F.lit("." + DEFAULT_EXTENSION))
    return F.when(F.contains(tail, F.lit(".")), tail).otherwise(named)


def curated_filename(identifier: Column, landing_path: Column) -> Column:
    return F.concat(remove_whitespace(identifier), F.lit("."), path_extension(landing_path))


def object_key(source: Column, body_code: Column, label: Column, filename: Column) -> Column:
    return F.concat(source, F.lit("/"), body_code, F.lit("/"), label, F.lit("/"), filename)


def key_filename(key: Column) -> Column:
    return _tail(key)


def handoff_filename(identifier_slug: Column, counter: Column, extension: Column) -> Column:
    """Name of a captured payload file; the counter keeps repeated references apart."""
    return F.concat(identifier_slug, F.lit("-"), counter.cast("string"), F.lit("."), extension)


def path_only(path: Column) -> Column:
    """Drop the local-file scheme so listed files and recorded paths compare equal."""
    return F.regexp_replace(path, "^file:(//)?", "")

"""Text clean-up columns.

Java regex classes are ASCII unless told otherwise and Java's ``\\v`` also eats
newlines, so every class below is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators U+001C..U+001F.
ANY_SPACE = r"(?U)[\s\x1c-\x1f]"
#: The same characters one by one, for trimming.
SPACES = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
INLINE_SPACE = r"[ \t\r\f\x0B]+"


def strip(c: Column) -> Column:
    """Cut Unicode white space at both ends; ``trim`` would only cut U+0020."""
    return F.btrim(c, F.lit(SPACES))


def collapse_whitespace(c: Column) -> Column:
    """Runs of in-line white space become one blank; newlines inside survive."""
    return strip(F.regexp_replace(c, INLINE_SPACE, " "))


def collapse_blank_lines(c: Column) -> Column:
    """Three or more newlines in a row become two."""
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def slugify_identifier(c: Column) -> Column:
    """Lower case, every run outside ``[a-z0-9]`` becomes one inner hyphen."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def remove_whitespace(c: Column) -> Column:
    """Delete all Unicode white space: the curated form of an identifier."""
    return F.regexp_replace(c, ANY_SPACE + "+", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def quoted(c: Column) -> Column:
    """Quote a value for a message: single quotes, double when it holds only single ones."""
    escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    only_single = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(only_single, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def reported_total(c: Column) -> Column:
    """The count a listing prints about itself: ``1,234 results`` -> 1234, else null."""
    # Fixed value: the phrase is part of the captured pages' format.
    digits = F.regexp_extract(c, r"(?iu)([0-9,]+)(?:[\s\x1c-\x1f\x85\xa0])+results", 1)
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint")

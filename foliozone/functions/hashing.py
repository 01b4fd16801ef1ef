"""Content hashes and comparison fingerprints, as columns over BINARY."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the stored form is ``algorithm:digest``.
HASH_PREFIX = "sha256:"


def content_hash(payload: Column) -> Column:
    return F.concat(F.lit(HASH_PREFIX), F.sha2(payload, 256))


def parse_hash(stored: Column) -> Column:
    """A stored hash, or null when it is empty or carries no algorithm."""
    return F.when(F.contains(stored, F.lit(":")), stored)


def comparison_fingerprint(fingerprint: Column, file_hash: Column) -> Column:
    return F.coalesce(parse_hash(fingerprint), parse_hash(file_hash))


def without_markers(payload: Column, patterns: tuple[str, ...]) -> Column:
    """Delete every match from the bytes. ISO-8859-1 maps bytes to chars one to one, so this is exact."""
    text = F.decode(payload, "ISO-8859-1")
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return F.encode(text, "ISO-8859-1")

"""Quality rules: repetition inside a text, and lines that many documents of a host share.

A line is hashed after lower-casing and with runs of digits and white space made one space. It is
boilerplate on a host if over ``LINE_DOCS`` documents of the host and over ``LINE_SHARE`` of them
have it. A document whose other lines keep less than ``LEAST`` of its characters is depleted and
rejected, as is one that fails the rules on its own text.

One pass over the texts leaves a few numbers and the lines' hashes; all joins work on these. Lines
are counted once for a document, with map-side sums; a row is known by an id given in that pass.

Null and empty texts have no words and fail. Documents without a source are one host. Repeated rows
are documents of their own. The whole path is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.llm.native import indices, let, no_nulls, words
from foliozone.llm.tables import same, text_key, wrapped
from foliozone.session import stage

LEAST_WORDS, REPEATED = 50, 50  # words; percent
LINE_DOCS, LINE_SHARE, LEAST = 10, 0.02, 0.5


def repeat_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array, first places included."""
    count = F.size(tokens) - 2
    grams = F.transform(indices(count), lambda i: F.struct(F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("h"), i.alias("p")))

    def twice(s: Column) -> Column:
        shared = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(shared, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")), lambda acc: acc["n"])

    hashes = F.transform(indices(count), lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    some = F.size(F.array_distinct(hashes)) < count
    return F.when((count > 1) & some, covered(let(F.sort_array(grams), twice))).otherwise(F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """The numbers of each text, its host, and hash and length of its lines."""
    text = no_nulls()
    filled = lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""
    lines = F.filter(F.split(text, "\n", -1), filled)
    places = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.when(filled(x), i)), lambda i: i.isNotNull())
    rows = docs.select(text_key().alias("text_key"), places.alias("places"), "doc_id", F.xxhash64("source").alias("host"), text.alias("t"), words(text).alias("w"), lines.alias("l"))
    normal = lambda x: F.xxhash64(F.lower(F.btrim(F.regexp_replace(x, r"[0-9\x20\x09-\x0D]+", " "))))
    return rows.select(
        "doc_id",
        "text_key",
        "host",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("w")).cast("bigint").alias("n_repeat_words"),
        F.transform("l", lambda x, i: F.struct(normal(x).alias("line"), F.length(x).alias("chars"), F.get("places", i).alias("place"))).alias("lines"),
        F.monotonically_increasing_id().alias("row"),
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """The columns of ``judge`` with text_key, host and removed_lines: the numbers of the boilerplate lines, from 0."""
    seen = stage(measured(docs), "measured_texts")
    hosts = seen.groupBy("host").agg(F.count("*").alias("docs"))
    counts = seen.select("host", F.explode(F.array_distinct("lines.line")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > LINE_DOCS)
    common = stage(counts.join(hosts, "host").filter(F.col("n") > LINE_SHARE * F.col("docs")).select("host", "line"), "common_lines")
    lines = seen.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.*")
    lost = lines.join(common, ["host", "line"], "left_semi").groupBy("row").agg(F.sum("chars").alias("lost"), F.sort_array(F.collect_list("place")).alias("removed"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    whole = F.aggregate("lines", F.lit(0).cast("bigint"), lambda acc, x: acc + x["chars"])
    gone = F.coalesce("lost", F.lit(0)).cast("bigint")
    return seen.join(lost, "row", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (whole - gone >= LEAST * whole)).alias("kept"),
        gone.alias("n_chars_lost"),
        "text_key",
        "host",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """A row for every row of ``docs``: the numbers, base_failed, n_chars_lost and kept."""
    return verdicts(docs).drop("text_key", "host", "removed_lines")


def cleaned(docs: DataFrame) -> DataFrame:
    """doc (the whole row as it was) and clean (its text without boilerplate lines), for every row that is kept."""
    kept = verdicts(docs).filter("kept").select("doc_id", "text_key", "host", "removed_lines").dropDuplicates(["doc_id", "text_key", "host"])
    rows = wrapped(docs).withColumn("host", F.xxhash64("doc.source"))
    left = F.filter(F.split(no_nulls(rows["text"]), "\n", -1), lambda x, i: ~F.array_contains(kept["removed_lines"], i))
    return rows.join(kept, same(rows, kept, "doc_id", "text_key", "host")).select("doc", F.array_join(left, "\n").alias("clean"))

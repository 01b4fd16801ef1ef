"""A training corpus out of raw documents, in stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; all
but the last return the columns of ``docs``. ``run`` writes every stage's result and reads it back, and
removes what the stage wrote on its way and the result before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone.llm import decontamination, language, secret_scan, sentence_pieces, simhash
from foliozone.llm.tables import same, small_batches, table, wrapped
from foliozone.session import discard, released, stage

#: A document goes if its language is unknown, or less sure than all others together.
LEAST_SCORE = 0.5
#: Near-duplicates: fingerprints of shingles of so many words that differ in so many bits at most.
SHINGLE, DISTANCE = 4, 4


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, and those whose language is not clear."""
    small_batches(spark)
    model = language.train(docs.filter(~language.held_out()))
    if not model.languages:  # nothing labelled to learn from: only texts without letters can be judged
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = wrapped(docs).select("doc", language.identified("text", model).alias("found"))
    return found.filter((F.col("found.lang") != "und") & (F.col("found.score") >= LEAST_SCORE)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every component of near-duplicates."""
    return simhash.first_of_each(docs, simhash.near_duplicates(docs, DISTANCE, SHINGLE))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold benchmark passages."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select("doc_id", "text_key").distinct()
    rows = wrapped(docs)
    return rows.join(bad, same(rows, bad, "doc_id", "text_key"), "left_anti").select("doc.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    clean = F.when(F.size("spans") > 0, secret_scan.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    found = secret_scan.scan(docs).select("doc", (F.size("spans") > 0).alias("changed"), clean.alias("clean"))
    columns = {c: F.col("doc")[c] for c in docs.columns} | {"text": F.col("clean")}
    if "n_chars" in columns:
        n = F.length("clean").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("changed"), n).otherwise(columns["n_chars"])
    return found.select(*(value.alias(name) for name, value in columns.items()))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the sampled pieces of the text, their number, and whether they decode to the text."""
    small_batches(spark)
    both = docs.select("doc_id", "lang", "source", sentence_pieces.round_trip("text", F.xxhash64("doc_id")).alias("r"))
    return both.select("doc_id", "lang", "source", F.col("r.ids").alias("piece_ids"), F.size("r.ids").cast("bigint").alias("n_pieces"), "r.lossless")


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", tokenized),
]

#: Fingerprints, trained models and sampling have no SQL: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        with released(spark):
            done = stage(step(spark, docs, sf_dir), name.replace(" ", "_"), kept=True)
        discard(docs)
        docs = done
    return docs

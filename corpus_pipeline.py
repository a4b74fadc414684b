"""A corpus pipeline over ``documents``: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import bpe_automaton, decontamination, language_id, line_dedup, near_dedup
from tracewright.llm.text import bucket_of
from tracewright.shared_storage import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told: those with a letter and no less sure than known ones.

    One document in five is not trained on; the labelled ones of them set the least score. Without labels
    nothing is learned, and every document with a letter stays.
    """
    held_out = bucket_of(F.col("doc_id")) == 0
    model = language_id.fit(docs.where(~held_out))
    if not model.languages:
        return docs.where(language_id.has_letter(F.col("text")))
    least = language_id.least_score(docs.where(held_out), model)
    # Columns of the corpus that are named like the new ones stay as they are.
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    found = language_id.identify(rows, model, least)
    return found.where(F.col("lang_pred") != language_id.UNDETERMINED).select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many documents repeat; ``text`` and ``n_chars`` are those of the lines kept."""
    deduped = line_dedup.dedup_lines(docs)
    lost = F.col("n_dropped") > 0
    new = {
        "text": F.when(lost, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(lost, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }
    return deduped.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five words, similarity 0.8 or more."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which at least one word in twenty lies in a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.matches(docs, items).where(~F.col("contaminated")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, packed as little-endian 32-bit integers."""
    encoded = bpe_automaton.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode_tokens),
]

#: SQL can't express the classifier, the tokenizer and connected groups.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs

"""One query per operator, over the whole given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import (
    bpe_automaton,
    centroid_clusters,
    chat_windows,
    decontamination,
    language_id,
    lattice_lm,
    line_dedup,
    near_dedup,
    phrases,
    pii,
    quality_rules,
    substring_dedup,
    token_files,
)
from tracewright.llm.text import bucket_of, sha256_hex
from tracewright.shared_storage import settle, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *columns)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    held_out = bucket_of(F.col("doc_id")) == 0
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(documents(spark, sf_dir))
    return deduped.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    token_files.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    tokens = token_files.read_tokens(spark, path).withColumn(
        "ids_crc32", token_files.ids_crc32(F.col("ids"))
    )
    return token_files.with_starts(tokens.drop("ids")).select(
        "doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32"
    )


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.judged(documents(spark, sf_dir))
    return judged.select("doc_id", *[F.col("quality")[c].alias(c) for c in counts], "base_failed", "kept")


@query
def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_automaton.encode(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False
    )
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.fit(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        sha256_hex(pii.joined(F.col("base"))).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.matches(documents(spark, sf_dir), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_hex(F.array_join("item_ids", ",")).alias("items_sha256"),
        "contaminated",
    )


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = near_dedup.NearRule(shingle_words=3, percent=85)
    groups = near_dedup.near_groups(documents(spark, sf_dir), rule)
    return groups.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scores(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = substring_dedup.dedup_passages(documents(spark, sf_dir))
    return deduped.select("doc_id", "n_words", "n_removed", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return centroid_clusters.clustered(vectors).select("vec_id", *centroid_clusters.NEW_COLUMNS)


@query
def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    turns = given.union(spark.createDataFrame(added, "conv_id bigint, turn bigint, role string, text string"))
    written = settle(chat_windows.windows(turns, public_tokenizers.path("byte_bpe_50k.json")))
    return chat_windows.digests(written)


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir, "lang"))

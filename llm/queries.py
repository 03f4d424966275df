"""The registered queries: each applies one operator to its whole table and digests the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.decontaminate import find_contamination
from llm.hard_negatives import mine_hard_negatives
from llm.html_text import extract_main_text
from llm.language_model import score_texts
from llm.merkle import lower_case_leaf, prove, verified
from llm.mixing import mix_sources
from llm.personal_data import KINDS, find_personal_data
from llm.oracle import SQL
from llm.quality import apply_rules
from llm.simhash import near_duplicate_groups
from llm.substrings import remove_repeated
from llm.tokens import count_tokens
from llm.toxicity import score_toxicity
from llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ruled = apply_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return ruled.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(documents, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(table(spark, folder, "documents").select("doc_id", "text"))


def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents").select("doc_id", "text"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    def named(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(documents, table(spark, folder, "labels"))
    return scored.withColumn("n_passages", F.size("passages")).drop("passages")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeated(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return cleaned.select(
        "doc_id", "text", F.size("removed").alias("n_removed"), F.array_join(spans, ",").alias("removed")
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", "text")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    extracted = extract_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", "n_chars")


def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_urls(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(*MANIFEST_FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(chosen, lower_case_leaf(MANIFEST_FIELDS, "text"))
    proofs = prove(documents, MANIFEST_FIELDS, "doc_id", "lang", {"tampered": tampered})
    checked = verified(proofs, F.coalesce("tampered", "leaf"))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", shifted)
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_model": op3_language_model,
    "op4_toxicity": op4_toxicity,
    "op5_personal_data": op5_personal_data,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_html_extraction": op8_html_extraction,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_url_filters": op11_url_filters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = dict(SQL)

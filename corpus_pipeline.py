"""A corpus from raw documents: rules, near-duplicates, benchmark passages, personal data, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.session import delete_folder, scratch_scope
from llm.common import scratch_path
from llm.decontaminate import find_contamination
from llm.mixing import mix_sources
from llm.personal_data import find_personal_data, redact
from llm.quality import apply_rules
from llm.simhash import keep_one_of_each_group

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What every stage but the last returns.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that break a rule; null and empty texts do."""
    return apply_rules(docs.select(*DOCUMENT)).filter("kept").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (SimHash of three words, two bits) the smallest id stays."""
    return keep_one_of_each_group(docs.select(*DOCUMENT)).select(*DOCUMENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs.select(*DOCUMENT), items).filter("n_hit = 0").select(*DOCUMENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind's name in place of personal data; `n_chars` follows the text."""
    clean = redact(find_personal_data(docs.select(*DOCUMENT)))
    length = F.when(F.size("spans") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*DOCUMENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicate by source towards the target weights, in a global random order."""
    return mix_sources(docs.select(*DOCUMENT))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: The near-duplicate stage hashes with XXH64, which DuckDB lacks; tests hold the rows against a
#: brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's result is written and read again by the next.

    A stage's own scratch tables go once its result is written, and so does the result before it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

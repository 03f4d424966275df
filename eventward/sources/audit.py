"""Raw records kept as they came, accepted and rejected, with typed access to any field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.sources.normalize import RAW, REASON

ACCEPTED = "accepted"


def audit_table(normalized: DataFrame) -> DataFrame:
    """(ord, source_file, accepted, reject_reason, raw): a row per record of `normalize_*_texts`.

    `raw` is a variant: the record's JSON with all its fields, also those that the event table
    has no column for, or, where the text is not JSON, the text itself. The event table stays as
    it is; the two meet by `ord`.
    """
    text = F.col(RAW)
    raw = F.coalesce(F.try_parse_json(text), text.cast("variant"))
    return normalized.select("ord", "source_file", F.col(REASON).isNull().alias(ACCEPTED), REASON, raw.alias(RAW))


def write_audit(normalized: DataFrame, path: str, mode: str = "overwrite") -> None:
    audit_table(normalized).write.mode(mode).partitionBy(ACCEPTED).parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The written table; reading accepted or rejected records alone opens only their files."""
    return spark.read.parquet(path).withColumn(ACCEPTED, F.col(ACCEPTED).cast("boolean"))


def raw_field(name: str, kind: str = "string") -> Column:
    """A field of the raw record as a type; null where it is missing or of another type, or the record is mere text."""
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(RAW, f"$['{escaped}']", kind)


def raw_text() -> Column:
    """The record's text where it is not JSON."""
    return F.when(F.schema_of_variant(RAW) == "STRING", F.try_variant_get(RAW, "$", "string"))

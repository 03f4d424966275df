"""All sources to one deduplicated event table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.catalog import EMULATION_LABELS
from eventward.operators.cleaning import deduplicate
from eventward.session import prepare
from eventward.sources.json_events import read_canonical_events, read_emulation_events
from eventward.sources.normalize import FILE_BITS, accepted, quarantined
from eventward.sources.xml_events import read_manifest_events

# Manifest entries come first, then the emulation files, then the canonical files: a million
# numbers of files for each.
_EMULATION_RANK = 1 << 20
_CANONICAL_RANK = 2 << 20


def _in_sequence(df: DataFrame, rank: int) -> DataFrame:
    return df.withColumn("ord", F.lit(rank << FILE_BITS) + F.col("ord"))


def _if_there(read) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            return None
        raise


def read_sources(
    spark: SparkSession,
    xml_root: str | None = None,
    manifest: DataFrame | None = None,
    emulation_folder: str | None = None,
    canonical_path: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Normalised rows of every source that is there, rejected rows included."""
    prepare(spark)
    parts = []
    if xml_root:
        parts.append(_if_there(lambda: read_manifest_events(spark, xml_root, manifest)))
    if emulation_folder:
        files = f"{emulation_folder.rstrip('/')}/{{{','.join(EMULATION_LABELS)}}}.json"
        emulation = _if_there(lambda: read_emulation_events(spark, files, strict=strict))
        parts.append(emulation and _in_sequence(emulation, _EMULATION_RANK))
    if canonical_path:
        canonical = _if_there(lambda: read_canonical_events(spark, canonical_path))
        parts.append(canonical and _in_sequence(canonical, _CANONICAL_RANK))
    found = [p for p in parts if p is not None]
    if not found:
        raise ValueError("no source found")
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def build_dataset(normalized: DataFrame) -> DataFrame:
    """Event table of normalised rows: accepted ones, without duplicates."""
    return deduplicate(accepted(normalized))


def quarantine(normalized: DataFrame) -> DataFrame:
    return quarantined(normalized)

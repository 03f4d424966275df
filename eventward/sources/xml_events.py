"""Windows event XML: exported log files, one text per event, or a column of such texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.catalog import UNKNOWN_HOST, XML_EMPTY_MARKS, XML_FIELDS, XML_FORMAT, manifest_table
from eventward.functions.times import xml_time
from eventward.sources.normalize import (
    INTEGER_FIELD_TEXT,
    FILE_BITS,
    RAW,
    file_ordinal,
    finish,
    sealed,
    whole_number,
)

EVENT_XML = (
    "System struct<EventID struct<_VALUE string, _Qualifiers string>, "
    "TimeCreated struct<_SystemTime string>, EventRecordID string, Computer string>, "
    "EventData struct<Data array<struct<_Name string, _VALUE string>>>"
)
_WITH_CORRUPT = f"{EVENT_XML}, _corrupt string"
_OPTIONS = {
    "rowTag": "Event", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
    "ignoreSurroundingSpaces": "false",
}


def _accepted_data(df: DataFrame) -> DataFrame:
    """Names and values of the usable Data elements, in document order, picked out once per row.

    Names feeding the same column are made equal, so the first match is the value to take.
    """
    known = [name for name in XML_FIELDS]
    value = lambda d: d["_VALUE"]
    usable = F.filter(
        "_event.EventData.Data",
        lambda d: d["_Name"].isin(known) & value(d).isNotNull() & (value(d) != "")
        & ~value(d).isin(*XML_EMPTY_MARKS),
    )
    renamed = F.transform("_usable", lambda d: F.when(d["_Name"] == "TargetSid", "TargetUserSid").otherwise(d["_Name"]))
    df = df.withColumn("_usable", usable)
    return df.withColumns({"_names": renamed, "_values": F.col("_usable._VALUE")})


def _data_value(name: str) -> Column:
    return F.get("_values", F.array_position("_names", name) - 1)


def _normalize(df: DataFrame) -> DataFrame:
    """`df` has _event (parsed struct), _corrupt (text that is no XML), raw, ord, source_dataset, source_file, label, tactic, technique."""
    df = _accepted_data(df)
    event_text = F.col("_event.System.EventID._VALUE")
    time_text = F.col("_event.System.TimeCreated._SystemTime")
    logon_text = _data_value("LogonType")
    names = {name: target for name, target in XML_FIELDS.items() if name != "TargetSid"}
    df = sealed(
        df,
        _number=whole_number(event_text),
        _time=xml_time(time_text),
        _logon=whole_number(logon_text, INTEGER_FIELD_TEXT),
        _computer=F.coalesce("_event.System.Computer", F.lit(UNKNOWN_HOST)),
        _record=F.nullif(F.col("_event.System.EventRecordID"), F.lit("")),
        _no_system=F.col("_event.System").isNull(),
        _no_number=event_text.isNull() | (event_text == ""),
        _no_time=time_text.isNull(),
        **{f"_{name}": _data_value(name) for name in names},
    )
    computer = F.col("_computer")
    columns = {target: F.col(f"_{name}") for name, target in names.items()}
    columns |= {
        "event_id": F.col("_number"),
        "timestamp": F.col("_time"),
        "computer": computer,
        "hostname_raw": computer,
        "logon_type": F.col("_logon"),
        "source_dataset": F.col("source_dataset"),
        "source_file": F.col("source_file"),
        "source_format": F.lit(XML_FORMAT),
        "record_id": F.col("_record"),
        "label": F.col("label"),
        "mitre_tactic": F.col("tactic"),
        "mitre_technique": F.col("technique"),
    }
    checks = [
        (F.col("_corrupt").isNotNull(), "malformed_xml"),
        (F.col("_no_system"), "no_system"),
        (F.col("_no_number"), "no_event_id"),
        (columns["event_id"].isNull(), "bad_event_id"),
        (F.col("_no_time"), "no_time"),
        (columns["timestamp"].isNull(), "bad_time"),
        (computer == "", "no_computer"),
        (F.col("_LogonType").isNotNull() & columns["logon_type"].isNull(), "bad_logon_type"),
        (F.col("source_dataset").isNull() | F.col("source_file").isNull(), "no_source"),
    ]
    return finish(df, columns, checks)


def normalize_xml_texts(df: DataFrame, text: str = "xml") -> DataFrame:
    """Parse a column of event XML texts.

    `df` needs ord, source_dataset, source_file, label, tactic and technique besides the text.
    """
    parsed = df.withColumn("_event", F.from_xml(F.col(text), _WITH_CORRUPT, _OPTIONS))
    corrupt = F.when(F.col("_event").isNull() | F.col("_event._corrupt").isNotNull(), F.col(text))
    return _normalize(parsed.withColumns({"_corrupt": corrupt, RAW: F.col(text)}))


def read_event_xml(
    spark: SparkSession, paths: str | list[str], source_dataset: str, label: str | None = None,
    tactic: str | None = None, technique: str | None = None,
) -> DataFrame:
    """Scan exported event XML files; events may span lines."""
    stamps = {
        "source_dataset": F.lit(source_dataset),
        "label": F.lit(label).cast("string"),
        "tactic": F.lit(tactic).cast("string"),
        "technique": F.lit(technique).cast("string"),
    }
    return _normalize(_scan(spark, paths).withColumns(stamps))


def _by_tag(spark: SparkSession) -> None:
    """Find events by their tag alone. Exports often have no element around their events, and Spark's
    other parser takes the first event for the whole file then."""
    spark.conf.set("spark.sql.legacy.useLegacyXMLParser", "true")


def _scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    _by_tag(spark)
    rows = (
        spark.read.format("xml")
        .options(**_OPTIONS)
        .schema(_WITH_CORRUPT)
        .load(paths)
    )
    return rows.select(
        F.struct("System", "EventData").alias("_event"),
        "_corrupt",
        F.col("_corrupt").alias(RAW),
        file_ordinal().alias("ord"),
        source_name().alias("source_file"),
        _decoded_path().alias("_path"),
    )


def _decoded_path() -> Column:
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(path)


def source_name() -> Column:
    """Base name of the scanned file, without the suffix of the XML export."""
    return F.regexp_replace(F.element_at(F.split(_decoded_path(), "/"), -1), r"(?i)\.xml$", "")


def _category(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def read_manifest_file(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written as YAML (category: list of file, label, tactic, technique)."""
    import yaml  # optional dependency; `manifest_table` needs none

    text = spark.read.text(path, wholetext=True).first()[0]
    entries = [
        (category, e["file"], e["label"], e["tactic"], e["technique"])
        for category, listed in yaml.safe_load(text).items()
        for e in listed
    ]
    return manifest_table(spark, entries)


def read_manifest_events(spark: SparkSession, root: str, manifest: DataFrame | None = None) -> DataFrame:
    """Scan `<root>/<category>/<file>[.xml]` for the manifest's files and stamp their labels.

    Files that the manifest does not name are not opened. The manifest is a small hand-written
    list; it is joined by its true size. `ord` orders the
    rows by manifest entry, then by place in the file.
    """
    manifest = manifest_table(spark) if manifest is None else manifest
    everything = f"{root.rstrip('/')}/*/*"
    listed = _files(spark, everything).join(
        manifest.select("category", "file"), ["category", "file"], "left_semi"
    )
    # No more than the manifest has entries; only these files are opened.
    paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", row.path) for row in listed.select("path").collect()]
    scanned = _scan(spark, paths) if paths else _scan(spark, everything).where(F.lit(False))
    return _normalize(_stamped(scanned, manifest))


def _stamped(scanned: DataFrame, manifest: DataFrame) -> DataFrame:
    entries = manifest.select(
        "file_rank", F.col("category").alias("_category"), F.col("file").alias("source_file"),
        "label", "tactic", "technique", F.col("label").alias("source_dataset"),
    )
    rows = scanned.withColumn("_category", _category(F.col("_path")))
    return rows.join(entries, ["_category", "source_file"]).withColumn(
        "ord", F.shiftleft(F.col("file_rank").cast("long"), FILE_BITS) + F.col("ord")
    )


def stream_event_xml(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Events of the files that appear under `<root>/<category>/`, as a feed for `feeds.ingest_stream`.

    Events may span lines. With `normalize_manifest_batch` as its step the feed gives the rows of
    `read_manifest_events`, accepted and rejected, numbered within their micro-batch.
    """
    _by_tag(spark)
    reader = spark.readStream.format("xml").options(**_OPTIONS).schema(_WITH_CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(f"{root.rstrip('/')}/*/*").select(
        F.struct("System", "EventData").alias("_event"), "_corrupt", F.col("_corrupt").alias(RAW),
        source_name().alias("source_file"), _decoded_path().alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
    )


def normalize_manifest_batch(manifest: DataFrame):
    """Stamp and normalise a micro-batch; files that the manifest does not name give no rows."""
    return lambda batch: _normalize(_stamped(batch, manifest))


def missing_manifest_files(spark: SparkSession, root: str, manifest: DataFrame | None = None) -> DataFrame:
    """Manifest entries without a file. Only the listing is read, no file content."""
    manifest = manifest_table(spark) if manifest is None else manifest
    return manifest.join(_files(spark, f"{root.rstrip('/')}/*/*"), ["category", "file"], "left_anti")


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    """Category, name and path of the files there are. Their content is not read."""
    found = spark.read.format("binaryFile").load(pattern).select("path")
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    return found.select(
        _category(path).alias("category"),
        F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)\.xml$", "").alias("file"),
        path.alias("path"),
    )

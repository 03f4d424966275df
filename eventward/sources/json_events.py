"""JSON-lines events: emulation captures with vendor field names, and canonical records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.catalog import EMULATION_LABELS, JSON_FIELDS, JSON_FORMAT, UNKNOWN_HOST
from eventward.functions.times import validated_time
from eventward.schema import LABEL_FIELDS, ORIGIN_FIELDS, STRING_FIELDS
from eventward.sources.normalize import (
    INTEGER_FIELD_TEXT,
    RAW,
    file_ordinal,
    finish,
    in_file_order,
    sealed,
    whole_number,
)
from eventward.sources.xml_events import source_name


# Standard JSON only.
_OPTIONS = {"allowSingleQuotes": "false"}
# Fixed value: white space around a line, as Unicode has it.
_SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
_MARK = "~"


def _parsed(df: DataFrame, text: str, texts: list[str], variants: list[str], strict: bool) -> DataFrame:
    """Parse each line once into `_fields`, null where it is not one object. Blank lines are no records.

    A line is read as the first of two elements of a list, of which the second carries the line's
    hash. A parser stops at the end of the first value that is whole and takes no notice of what
    follows it; a line that closes the list early, or adds elements, lacks the mark behind one object.

    Variant fields keep the JSON type and tell a null from an absent key. Text fields read
    numbers as text; with `strict` they are variants too, so that their type can be checked.
    """
    types = {name: "variant" if strict else "string" for name in texts}
    types |= {name: "variant" for name in variants} | {_MARK: "bigint"}
    schema = ", ".join(f"`{name}`:{kind}" for name, kind in types.items())
    line = F.btrim(F.col(text), F.lit(_SPACE))
    mark = F.xxhash64(line)
    whole = F.concat(F.lit("["), line, F.lit(f',{{"{_MARK}":'), mark.cast("string"), F.lit("}]"))
    listed = F.from_json(whole, f"array<struct<{schema}>>", _OPTIONS)
    # An array function on a list of two keeps the parsing in one place.
    start = F.struct(
        F.lit(0).alias("n"), F.lit(None).cast(f"struct<{schema}>").alias("it"), F.lit(None).cast("bigint").alias("mark")
    )
    single = F.aggregate(
        listed,
        start,
        lambda acc, x: F.struct(
            (acc["n"] + 1).alias("n"), F.when(acc["n"] == 0, x).otherwise(acc["it"]).alias("it"), x[_MARK].alias("mark")
        ),
        lambda acc: F.when((acc["n"] == 2) & (acc["mark"] == mark), acc["it"]),
    )
    return df.where(line != "").withColumns({RAW: F.col(text), "_fields": single})


def _value(key: str) -> Column:
    return F.col("_fields")[key]


def _texts(names: list[str], strict: bool) -> dict[str, Column]:
    return {f"_{name}": _text(name, strict) for name in names}


def _text(key: str, variant: bool) -> Column:
    """Value as text; a null value has none."""
    return F.try_variant_get(_value(key), "$", "string") if variant else _value(key)


def _present(key: str) -> Column:
    return _value(key).isNotNull()


def _given(key: str) -> Column:
    """The key is there with a value other than null."""
    return _present(key) & ~F.is_variant_null(_value(key))


def _is_text(key: str) -> Column:
    return F.schema_of_variant(_value(key)) == "STRING"


def _event_number(key: str) -> Column:
    """Texts must be whole numbers; numbers are cut to whole ones."""
    as_number = F.try_variant_get(_value(key), "$", "double")
    as_number = F.when(~F.isnan(as_number), as_number)
    number = F.when(as_number >= 0, F.floor(as_number)).otherwise(F.ceil(as_number))
    return F.when(_is_text(key), whole_number(_text(key, True))).otherwise(number.try_cast("int"))


def _not_text(keys: list[str]) -> Column:
    """Some of the keys holds a value that is neither text nor null."""
    wrong = F.lit(False)
    for key in keys:
        wrong = wrong | (_given(key) & ~_is_text(key))
    return wrong


def _malformed() -> tuple[Column, str]:
    return F.col("_broken"), "malformed_json"


def _broken() -> Column:
    return F.col("_fields").isNull()


def normalize_emulation_texts(df: DataFrame, text: str = "value", strict: bool = False) -> DataFrame:
    """Parse vendor-named JSON lines. `df` needs ord, source_dataset, source_file, label and the text.

    `strict` rejects rows whose text fields hold numbers; otherwise these are read as text.
    """
    names = [name for name in JSON_FIELDS if name != "LogonType"]
    rows = _parsed(
        df, text, names, ["EventID", "EventTime", "@timestamp", "Hostname", "host", "RecordNumber", "LogonType"],
        strict,
    )

    def given_text(key: str) -> Column:
        return F.nullif(_text(key, True), F.lit(""))

    rows = sealed(
        rows,
        _number=_event_number("EventID"),
        _time=validated_time(F.coalesce(given_text("EventTime"), given_text("@timestamp"))),
        _computer=F.when(_present("Hostname"), _text("Hostname", True))
        .when(_present("host"), _text("host", True))
        .otherwise(F.lit(UNKNOWN_HOST)),
        _logon=whole_number(_text("LogonType", True), INTEGER_FIELD_TEXT),
        _logon_given=_given("LogonType"),
        _number_given=_present("EventID"),
        _broken=_broken(),
        _wrong_type=_not_text([*names, "Hostname", "host"]) if strict else F.lit(False),
        _host=_text("Hostname", True),
        _record=_text("RecordNumber", True),
        **_texts(names, strict),
    )
    columns = {JSON_FIELDS[name]: F.col(f"_{name}") for name in names}
    columns |= {
        "event_id": F.col("_number"),
        "timestamp": F.col("_time"),
        "computer": F.col("_computer"),
        "hostname_raw": F.col("_host"),
        "logon_type": F.col("_logon"),
        "source_dataset": F.col("source_dataset"),
        "source_file": F.col("source_file"),
        "source_format": F.lit(JSON_FORMAT),
        "record_id": F.col("_record"),
        "label": F.col("label"),
    }
    checks = [
        _malformed(),
        (~F.col("_number_given"), "no_event_id"),
        (columns["event_id"].isNull(), "bad_event_id"),
        (columns["timestamp"].isNull(), "bad_time"),
        (columns["computer"].isNull(), "no_computer"),
        (F.col("_logon_given") & columns["logon_type"].isNull(), "bad_logon_type"),
        (F.col("_wrong_type"), "not_text"),
    ]
    return finish(rows, columns, checks)


def normalize_canonical_texts(df: DataFrame, text: str = "value", strict: bool = True) -> DataFrame:
    """Parse JSON lines that already carry the canonical names. `df` needs ord, source_file and the text.

    The file name stays with rejected rows only; accepted rows carry their own `source_file`.
    """
    names = [*STRING_FIELDS, *ORIGIN_FIELDS, *LABEL_FIELDS]
    rows = _parsed(
        df.withColumnRenamed("source_file", "_file"), text, names,
        ["event_id", "timestamp", "computer", "logon_type"], strict,
    )
    rows = sealed(
        rows,
        _number=_event_number("event_id"),
        _time=validated_time(_text("timestamp", True)),
        _computer=F.when(_present("computer"), _text("computer", True)).otherwise(F.lit(UNKNOWN_HOST)),
        _logon=whole_number(_text("logon_type", True), INTEGER_FIELD_TEXT),
        _logon_given=_given("logon_type"),
        _broken=_broken(),
        _wrong_type=_not_text([*names, "computer"]) if strict else F.lit(False),
        **_texts(names, strict),
    )
    columns = {name: F.col(f"_{name}") for name in names}
    columns |= {
        "event_id": F.col("_number"),
        "timestamp": F.col("_time"),
        "computer": F.col("_computer"),
        "logon_type": F.col("_logon"),
    }
    no_source = F.lit(False)
    for name in ("source_dataset", "source_file", "source_format"):
        no_source = no_source | columns[name].isNull()
    checks = [
        _malformed(),
        (columns["event_id"].isNull(), "bad_event_id"),
        (columns["timestamp"].isNull(), "bad_time"),
        (columns["computer"].isNull(), "no_computer"),
        (F.col("_logon_given") & columns["logon_type"].isNull(), "bad_logon_type"),
        (no_source, "no_source"),
        (F.col("_wrong_type"), "not_text"),
    ]
    columns["source_file"] = F.coalesce(columns["source_file"], "_file")
    return finish(rows, columns, checks)


def scan_lines(spark: SparkSession, paths: str | list[str], stems: Sequence[str] = ()) -> DataFrame:
    """Text lines with their place, counted over all files, and file name."""
    lines = spark.read.text(paths)
    numbered = lines.select(
        "value", file_ordinal().alias("ord"), source_name().alias("source_file"), F.col("_metadata.file_path").alias("_path")
    )
    return in_file_order(numbered, lines.inputFiles(), stems)


def file_stem() -> Column:
    return F.regexp_replace("source_file", r"\.[^.]*$", "")


def read_emulation_events(
    spark: SparkSession, paths: str | list[str], source_dataset: str | None = None, strict: bool = False
) -> DataFrame:
    """Scan emulation captures; the data set and the label are the file name without suffix.

    Files come in the order of the known captures, then of paths.
    """
    dataset = file_stem() if source_dataset is None else F.lit(source_dataset)
    lines = scan_lines(spark, paths, EMULATION_LABELS).withColumns({"source_dataset": dataset, "label": file_stem()})
    return normalize_emulation_texts(lines, strict=strict)


def read_canonical_events(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    return normalize_canonical_texts(scan_lines(spark, paths), strict=strict)

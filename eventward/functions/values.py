"""Column expressions on event fields: presence, clean values, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventward.catalog import DISPLAY_FIELDS, UNKNOWN_DESCRIPTION
from eventward.functions.times import iso_text


def presence_flag(column: str, data_type: T.DataType, empty_is_present: bool) -> Column:
    """1 where the field has a value. Whether an empty text is a value is the caller's choice."""
    present = F.col(column).isNotNull()
    if not empty_is_present:
        if isinstance(data_type, T.StringType):
            present = present & (F.col(column) != "")
        elif isinstance(data_type, (T.DoubleType, T.FloatType)):
            present = present & ~F.isnan(column)
    return present.cast("int")


def clean_value(column: str, data_type: T.DataType) -> Column:
    """JSON-safe form: NaN becomes null, times become ISO text."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), F.col(column))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(column)
    return F.col(column)


def clean_columns(df: DataFrame) -> list[Column]:
    return [
        clean_value(f.name, f.dataType).alias(f.name) for f in df.schema.fields if f.name != "raw"
    ]


def directory_path(computer: str | Column = "computer") -> Column:
    """Directory-style path of a host name: domain parts first, then the host."""
    c = F.col(computer) if isinstance(computer, str) else computer
    parts = F.split(c, r"\.")
    domain = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
                         lambda p: F.concat(F.lit("DC="), p))
    return (
        F.when(c.isNull() | (c == ""), F.array(F.lit("DC=unknown")))
        .when(F.size(parts) < 2, F.array(F.concat(F.lit("CN="), c)))
        .otherwise(F.array(F.array_join(domain, ","), F.concat(F.lit("CN="), parts[0])))
    )


def display_fields(df: DataFrame) -> Column:
    """JSON object of the non-null display fields in their fixed order."""
    names = [c for c in DISPLAY_FIELDS if c in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [clean_value(c, types[c]).alias(c) for c in names]
    nothing = F.lit(True)
    for c in names:
        nothing = nothing & F.col(c).isNull()
    empty = F.lit('{"event_id":null,"computer":null}')
    return F.when(nothing, empty).otherwise(F.to_json(F.struct(*fields)))


def sentence_case(label: Column) -> Column:
    """Underscores to blanks, first letter upper, the rest lower."""
    words = F.replace(label, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.lower(F.substring(words, 2, 1 << 30)))


def fallback_description(label: Column) -> Column:
    return F.when(label.isNull() | (label == ""), F.lit(UNKNOWN_DESCRIPTION)).otherwise(
        sentence_case(label)
    )

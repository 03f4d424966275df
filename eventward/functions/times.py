"""Column expressions on event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted time patterns (date, blank or T, up to six decimals, optional Z
# after a T) and the wider ISO form of the XML source.
ACCEPTED_TIME = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"( \d{1,2}:\d{1,2}:\d{1,2}|T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z?)$"
)
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2}(:\d{2})?)?)?$"
)


def event_micros(column: str | Column = "timestamp") -> Column:
    """Microseconds since 1970 of a zone-free time (the session runs in UTC)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(c.cast("timestamp"))


def to_naive(text: Column) -> Column:
    return text.try_cast("timestamp").cast("timestamp_ntz")


def validated_time(text: Column) -> Column:
    """Time of a text in one of the accepted patterns, otherwise null. `Z` is dropped."""
    return F.when(text.rlike(ACCEPTED_TIME), to_naive(F.regexp_replace(text, "Z$", "")))


def xml_time(text: Column) -> Column:
    """Time of a `SystemTime` attribute: offsets are turned into UTC, others read as they are."""
    cut = F.substring_index(F.substring_index(text, ".", 1), "+", 1)
    return F.when(
        text.rlike(ISO_TIME),
        F.coalesce(to_naive(F.replace(text, F.lit(","), F.lit("."))), validated_time(F.replace(cut, F.lit(" "), F.lit("T")))),
    ).otherwise(validated_time(F.replace(cut, F.lit(" "), F.lit("T"))))


def iso_text(column: str | Column) -> Column:
    """ISO text of a time, with decimals only where there are some."""
    c = F.col(column) if isinstance(column, str) else column
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    decimals = F.date_format(c, ".SSSSSS")
    return F.when(decimals == ".000000", whole).otherwise(F.concat(whole, decimals))


def hour_of(column: str = "timestamp") -> Column:
    return F.hour(column)


def weekday_of(column: str = "timestamp") -> Column:
    """Monday is 0."""
    return F.weekday(column)


def business_hours_flag(column: str = "timestamp") -> Column:
    return F.coalesce(F.hour(column).between(8, 18).cast("int"), F.lit(0))


def weekend_flag(column: str = "timestamp") -> Column:
    return F.coalesce((F.weekday(column) >= 5).cast("int"), F.lit(0))

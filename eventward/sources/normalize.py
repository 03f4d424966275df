"""From parsed log records to the canonical event table, with reasons for rejected rows.

Each source projects its records to the canonical columns as text plus `_checks`, an array of
(failed, reason) pairs; `finish` types the columns and names the first failed check. Accepted
and rejected rows stay in one DataFrame, so that one scan can feed both tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventward.schema import EVENT_COLUMNS, EVENT_SCHEMA, ORDINAL
from eventward.session import stored

REASON = "reject_reason"
RAW = "raw"

# Fixed value: whole numbers as text, blanks and a zero fraction allowed.
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
INTEGER_FIELD_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"


def whole_number(text: Column, pattern: str = INTEGER_TEXT) -> Column:
    """Integer value of a text, null if it is none."""
    return F.when(text.rlike(pattern), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("int"))


def file_ordinal() -> Column:
    """Position of a record in its file, increasing along the file.

    It adds the start of the file block to the record number in the task. A task reads at most
    as many records as a block has bytes, so the numbers of two blocks never meet.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return F.col("_metadata.file_block_start") + in_task


#: Bits of `ord` for the place in a file (a terabyte); the file's number stands above them.
FILE_BITS = 40


def in_file_order(rows: DataFrame, files: list[str], stems: Sequence[str] = ()) -> DataFrame:
    """Put the number of a row's file above its place in `ord`; drops `_path`.

    Files stand in order of `stems`, where their names without suffix are listed, then of paths.

    The list of files is the one that Spark's scan has made; no file is opened for it. The
    numbers are joined by the size of the stored table.
    """
    spark = rows.sparkSession
    place_of = {stem: place for place, stem in enumerate(stems)}

    def order(path: str) -> tuple[int, str]:
        return place_of.get(re.sub(r"\.[^.]*$", "", unquote(path.rsplit("/", 1)[-1])), len(stems)), path

    # A file's address comes with one slash behind the scheme or with three, encoded or not.
    named = [(number, unquote(re.sub(r"^(\w+):/+", r"\1:/", path))) for number, path in enumerate(sorted(set(files), key=order))]
    numbers = stored(spark.createDataFrame(named, "_file bigint, _path string"), "file-order")
    path = F.regexp_replace("_path", r"^(\w+):/+", "$1:/")
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    unknown = F.raise_error(F.concat(F.lit("no number for file "), F.col("_path"))).cast("bigint")
    place = F.shiftleft(F.coalesce("_file", unknown), FILE_BITS) + F.col("ord")
    return rows.withColumn("_path", path).join(numbers, "_path", "left").withColumn("ord", place).drop("_file", "_path")


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(failed, F.lit(True)), F.lit(name)) for failed, name in checks],
                      F.lit(None).cast("string"))


def sealed(df: DataFrame, **parsed: Column) -> DataFrame:
    """Add values taken from a parsed record, behind a generator that filters do not pass.

    A filter on the reject reason would otherwise be moved below the parsing, and each check
    would parse the record again. All that later columns need must be a plain value here, so
    that one generator is enough and none of its fields is taken apart above it.
    """
    row = F.struct(*[value.alias(name) for name, value in parsed.items()])
    return df.select("*", F.inline(F.array(row)))


def finish(df: DataFrame, columns: dict[str, Column], checks: list[tuple[Column, str]]) -> DataFrame:
    """Project to `ord`, the canonical columns, the reject reason and the raw text."""
    typed = [
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields
    ]
    return df.select(ORDINAL, *typed, first_reason(checks).alias(REASON), RAW)


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(REASON).isNull()).select(ORDINAL, *EVENT_COLUMNS)


def quarantined(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col(REASON).isNotNull()).select("source_file", ORDINAL, REASON, RAW)


def write_with_quarantine(normalized: DataFrame, path: str) -> None:
    """One pass over the source: both tables in one dataset, partitioned by `accepted`.

    The raw text is kept for rejected rows only.
    """
    ok = F.col(REASON).isNull()
    normalized.withColumns({"accepted": ok, RAW: F.when(~ok, F.col(RAW))}).write.mode(
        "overwrite"
    ).partitionBy("accepted").parquet(path)


def read_with_quarantine(spark, path: str) -> tuple[DataFrame, DataFrame]:
    table = spark.read.parquet(path)  # partition values are read as text
    return accepted(table.where("accepted = 'true'")), quarantined(table.where("accepted = 'false'"))

"""Small helpers that the operators share."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward import session
from eventward.session import scratch_path, stored

__all__ = ["SPACES", "drop_columns", "in_one_row", "lower_ascii", "map_batches", "scratch_path", "shielded", "ship", "stored"]

#: The characters that end a word, as a regular-expression class body.
SPACES = r"\x20\x09-\x0D"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Leave out columns that an operator is about to add; the operator's own columns win.

    Names are compared as Spark resolves them, without regard to case.
    """
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in taken])


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator name its own columns with two underscores before or behind.

    Columns of the first argument that are named so are renamed meanwhile, and any arguments that
    name them with them; they come back under their names. Tables without such names pass as
    they are.
    """

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **settings) -> DataFrame:
        theirs = [c for c in df.columns if c.startswith("__") or c.endswith("__")]
        if not theirs:
            return operator(df, *args, **settings)
        taken = {c.lower() for c in df.columns}
        free = (name for n in range(len(df.columns) + len(theirs)) if (name := f"input column {n}") not in taken)
        meanwhile = dict(zip(theirs, free, strict=False))
        renamed = lambda value: meanwhile.get(value, value) if isinstance(value, str) else value
        found = operator(
            df.withColumnsRenamed(meanwhile), *map(renamed, args), **{k: renamed(v) for k, v in settings.items()}
        )
        return found.withColumnsRenamed({there: name for name, there in meanwhile.items() if there in found.columns})

    return run


def in_one_row(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns below a one-row generator.

    Filters and later expressions are not merged into what stands below a generator, so each
    value is computed once per row, however often it is used above.
    """
    fields = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(fields)))


def lower_ascii(text: Column) -> Column:
    """Lower-case the letters A to Z and no others."""
    return F.translate(text, UPPER, LOWER)


def ship(spark: SparkSession) -> None:
    """Send this package and what it imports to the Python workers."""
    session.ship(spark, "llm", "eventward")


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """`mapInArrow` with a function from one record batch to one record batch, or to several."""

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)

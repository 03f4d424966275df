"""Substring deduplication: digests of normalised sentences, grouped over the whole corpus.

Texts are cut at line ends and after sentence ends. A unit's digest is that of its words, lower
case, without signs at their edges. Of all units with a digest the earliest ranked stays: that
of the smallest id, then of the earliest place. The rest is removed, with its offsets retained.
Short units recur by chance ("Of the."), so a stretch of repeated units is removed only if together
they have `least_words` words, or if it is all that the text has and no shorter than `least_text`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, shielded, ship, stored

LEAST_WORDS, LEAST_TEXT = 20, 5
# Line ends, blanks behind a sentence's end, and the ends of sentences that no blank follows.
_END = re.compile(r"\n+|(?<=[.!?\u2026\u061f\u06d4\u0964\u0965])[ \t]+|(?<=[\u3002\uff01\uff1f\uff61])[ \t\u3000]*")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_UNITS = "array<struct<start:int,end:int,words:int,a:bigint,b:bigint>>"


def units_of(text: str) -> list[tuple[int, int]]:
    """Starts and ends (code points) of the units of a text; separators belong to none."""
    found, start = [], 0
    for gap in _END.finditer(text):
        if gap.start() > start:
            found.append((start, gap.start()))
        start = gap.end()
    if start < len(text):
        found.append((start, len(text)))
    return found


def digest(unit: str) -> tuple[int, int, int]:
    """Number of words and a 128-bit digest as two signed numbers; units without words have none."""
    words = _WORD.findall(unit.lower())
    value = xxhash.xxh3_128_digest(" ".join(words))
    return len(words), int.from_bytes(value[:8], "big", signed=True), int.from_bytes(value[8:], "big", signed=True)


def _unit_column(texts: pa.Array) -> pa.Array:
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])
    start, end, words, a, b, edges = [], [], [], [], [], [0]
    for text in texts.to_pylist():
        for low, high in units_of(text or ""):
            count, left, right = digest(text[low:high])
            if count:
                start.append(low)
                end.append(high)
                words.append(count)
                a.append(left)
                b.append(right)
        edges.append(len(start))
    columns = [pa.array(c, t.type) for c, t in zip((start, end, words, a, b), kind, strict=True)]
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(kind)))


def _stretches(batches: Iterator[pa.RecordBatch], least_words: int, least_text: int) -> Iterator[pa.RecordBatch]:
    """From a document's number of units and its repeated ones, as (number, start, end, words), what is removed."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        out = []
        for whole, repeated in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            stretches: list[list] = []
            for unit in sorted(repeated, key=lambda u: u["number"]):
                if stretches and unit["number"] == stretches[-1][0] + 1:
                    stretches[-1][0] = unit["number"]
                    stretches[-1][2] = unit["end"]
                    stretches[-1][3] += unit["words"]
                else:
                    stretches.append([unit["number"], unit["start"], unit["end"], unit["words"]])
            least = least_text if len(repeated) == whole else least_words
            out.append([{"start": a, "end": b} for _, a, b, words in stretches if words >= least])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.list_(span))], ["__key", "__id", "removed"]
        )


@shielded
def remove_repeated(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, least_text: int = LEAST_TEXT
) -> DataFrame:
    """Replace texts by what is left, and add `removed`: offsets (code points) in the text as it was.

    What is left is the text without these stretches, character by character; blanks that stood
    around a stretch stay.

    Null texts stay null and empty ones empty; texts without words have no units. Rows that
    repeat both id and text are one document and keep the same units. Null ids rank last, among
    rows with one id, or none, a hash of the text decides. Long texts are cut whole; ties have
    one winner, the first in rank. An empty table stays empty; an input column `removed` is
    replaced, others keep their names. A unit that is everywhere is one partial minimum in each
    task, and the rows that hold it are dealt out by a skew join, not gathered.
    """
    ship(df.sparkSession)
    df = drop_columns(df, "removed", "__key")
    key = F.xxhash64(doc_id, text)
    id_type = df.select(F.col(doc_id).alias("id")).schema["id"].dataType.simpleString()
    units = F.arrow_udf(_unit_column, _UNITS)(F.col(text))
    documents = df.select(F.col(doc_id).alias("id"), key.alias("key"), units.alias("units"))
    rows = documents.select("id", "key", F.size("units").alias("of"), F.posexplode("units").alias("number", "u"))
    rows = stored(rows.select("id", "key", "of", "number", "u.*"), "text-units")

    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("key").alias("key"), F.col("number").alias("number"))
    firsts = rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(rank).alias("first")).filter("n > 1").drop("n")
    # Written, so that the join reads both sides by shuffles of their own, which it can split.
    firsts = stored(firsts, "first-units")
    repeated = rows.join(firsts, ["a", "b"]).filter(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")) & (F.col("number") == F.col("first.number")))
    )
    unit = F.struct("number", "start", "end", "words")
    # A repeated row names its units as often as it comes; a set counts them once.
    mine = repeated.groupBy("key", "id").agg(F.first("of").alias("of"), F.collect_set(unit).alias("units"))
    spans = mine.mapInArrow(
        lambda batches: _stretches(batches, least_words, least_text),
        f"__key bigint, __id {id_type}, removed array<struct<start:int,end:int>>",
    )
    spans = spans.filter(F.size("removed") > 0)
    whole = df.withColumn("__key", key)
    same = (whole["__key"] == spans["__key"]) & whole[doc_id].eqNullSafe(spans["__id"])
    joined = whole.join(spans, same, "left").drop(whole["__key"]).drop("__key", "__id")
    removed = F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>"))
    left = F.aggregate(
        F.col("removed"),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.lit(2**31 - 1))),
    )
    cleaned = F.when(F.size("removed") > 0, left).otherwise(F.col(text))
    return joined.withColumns({text: cleaned, "removed": removed})

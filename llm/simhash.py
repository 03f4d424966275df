"""SimHash near-duplicates: pivot distance tables over fingerprints, and exact verification.

A fingerprint's row in the pivot table is its Hamming distance to each of sixteen reference
fingerprints. Distances are a metric, so two fingerprints within two bits differ by two at most
in every coordinate; pairs with a larger maximum difference are discarded, survivors are
verified by their differing bits. Which pairs meet at all is settled by equal 16-bit blocks:
two fingerprints within two bits agree on two of their four blocks at least.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, shielded, ship, stored
from llm.graph import components

SHINGLE, SEED, RADIUS = 3, 42, 2
PIVOTS = 16
#: Fingerprints in a bucket up to which its pairs are compared; larger buckets go by midpoints,
#: with the same links. The number moves work only.
PAIRED = 64

LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number; 0 without words."""
    words = text.translate(LOWER_BYTES).split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(x) for x in zip(*[words[k:] for k in range(SHINGLE)], strict=False)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # 64 bytes a shingle, so in steps
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(hashes))
    return _signed(sum(1 << int(bit) for bit in set_bits))


def fingerprints(text: Column) -> Column:
    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t) for t in texts.to_pylist()], pa.int64())

    return F.arrow_udf(batch, "bigint")(text)


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, the same in every run."""
    return [_signed(xxhash.xxh64_intdigest(f"pivot {k}", SEED)) for k in range(count)]


def _table(value: Column) -> list[Column]:
    """The pivot distances, eight to a number: each takes seven bits, so a byte."""
    columns, points = [], pivots()
    for first in range(0, PIVOTS, 8):
        packed = F.lit(0).cast("bigint")
        for k, point in enumerate(points[first : first + 8]):
            distance = F.bit_count(value.bitwiseXOR(F.lit(point))).cast("bigint")
            packed = packed.bitwiseOR(F.shiftleft(distance, 8 * k))
        columns.append(packed.alias(f"d{first // 8}"))
    return columns


def _maximum_difference() -> Column:
    parts = []
    for number in range(PIVOTS // 8):
        for k in range(8):
            a, b = (F.shiftrightunsigned(F.col(f"{s}.d{number}"), 8 * k).bitwiseAND(F.lit(255)) for s in "ab")
            parts.append(F.abs(a - b))
    return F.greatest(*parts)


def _block_keys(value: Column) -> Column:
    """A key for each two of the four 16-bit blocks; the number of the choice is part of it."""
    blocks = [F.shiftrightunsigned(value, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    keys = []
    for number, (i, j) in enumerate(combinations(range(4), 2)):
        key = F.shiftleft(blocks[i], 16).bitwiseOR(blocks[j])
        keys.append(key.bitwiseOR(F.lit(number << 32)))
    return F.array(*keys)


def links(values: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of `values(f)` within two bits.

    Buckets of up to `PAIRED` fingerprints give all their pairs within two bits. In a larger
    bucket two fingerprints within two bits are both within one bit of some third number: each
    member names itself and its 64 neighbours, and all that name one number, 65 at most, are
    linked to the smallest of them. Such links are pairs within two bits too.
    """
    keyed = values.select("f", F.explode(_block_keys(F.col("f"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(sizes, "key").select("key", "f", "n", *_table(F.col("f")))
    shared = stored(shared, "shared-blocks")
    few = shared.filter(F.col("n") <= PAIRED)
    bits = F.bit_count(F.col("a.f").bitwiseXOR(F.col("b.f")))
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.f") < F.col("b.f"))
    pairs = few.alias("a").join(few.alias("b"), meet & (_maximum_difference() <= RADIUS) & (bits <= RADIUS))
    pairs = pairs.select(F.col("a.f").alias("a"), F.col("b.f").alias("b"))
    many = shared.filter(F.col("n") > PAIRED).select("f").distinct()
    near = F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)])
    named = many.select("f", F.explode(near).alias("number")).groupBy("number").agg(F.collect_list("f").alias("all"))
    stars = named.filter(F.size("all") > 1).select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return pairs.union(stars.filter("a <> b"))


def _linked(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, row, f), and for each fingerprint (f, root)."""
    ship(df.sparkSession)
    rows = df.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(doc_id, text).alias("row"),
        fingerprints(F.col(text).cast("binary")).alias("f"),
    )
    rows = stored(rows, "fingerprints")
    values = stored(rows.groupBy("f").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(values.select("f")))
    whole = values.join(roots.withColumnRenamed("v", "f"), "f", "left")
    return rows, whole.select("f", "least_id", F.coalesce("root", "f").alias("root"))


def near_duplicate_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row; other columns are not returned.

    Fingerprints are over three-word shingles, repeats included, and link at two differing bits
    or fewer; a component's id is the smallest id in it. Null, empty and wordless texts have
    fingerprint zero and link like any other. A row without id gets its component's id, null
    if no row of the component has one. Repeated rows appear as often as they come; an empty
    table gives none. Copies are one vertex, so a text copied any number of times costs one. Very long
    texts are hashed whole, in steps.
    """
    rows, values = _linked(df, doc_id, text)
    values = stored(values, "fingerprint-roots")
    least = values.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = values.select("f", "root").join(least, "root").select("f", "component_id")
    found = rows.join(named, "f")
    return found.select(
        F.col("id").alias(doc_id),
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@shielded
def keep_one_of_each_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Rows without id come after all others; of rows with one id, and of rows without, one is
    chosen by a hash of the text, and of rows that repeat one stays. Null, empty and wordless texts are
    one group, and an empty table stays empty. All columns are returned, whatever their names.
    """
    rows, values = _linked(df, doc_id, text)
    return keep_best(df, rows, values, doc_id, text)


def keep_best(df: DataFrame, rows: DataFrame, values: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Of all `rows(id, row, f)` whose f have one root in `values(f, root)` the first row of `df`."""
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))
    best = rows.groupBy("f").agg(F.min(rank).alias("best"))
    best = best.join(values.select("f", "root"), "f").groupBy("root").agg(F.min("best").alias("best"))
    chosen = best.select(F.col("best.id").alias("__id"), F.col("best.row").alias("__row"))
    whole = drop_columns(df, "__id", "__row").withColumn("__row", F.xxhash64(doc_id, text))
    same = (whole["__row"] == chosen["__row"]) & whole[doc_id].eqNullSafe(chosen["__id"])
    return whole.join(chosen, same, "left_semi").dropDuplicates(["__row", doc_id]).drop("__row")

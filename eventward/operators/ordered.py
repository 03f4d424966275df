"""Running sums and neighbours along an order, for groups of any size.

A window function sorts one whole group in one task. That is right for ordinary groups, but
one user, host or label may hold a third of all rows. `ordered_scan` therefore counts the
groups first (one column-pruned aggregate with partial sums). Groups up to `max_group_rows`
take a plain window. The rows of larger groups are range-partitioned over (group, order),
which cuts a group into chunks of similar size; each chunk is scanned alone, and the chunk
totals, a table of at most one row per chunk and group, carry the values over the cuts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventward.session import shared_folder, stored

MAX_GROUP_ROWS = 500_000


@dataclass
class GroupSizes:
    """Rows of ordinary groups, rows of large groups (None if there are none) and their number."""

    small: DataFrame
    large: DataFrame | None
    large_rows: int


def split_by_group_size(df: DataFrame, keys: list[str], max_group_rows: int) -> GroupSizes:
    """Keys must not be null."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group_rows)
    n_keys, n_rows = sizes.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not n_keys:
        return GroupSizes(df, None, 0)
    large = stored(sizes.select(*keys), "large-groups")
    return GroupSizes(
        df.join(large, keys, "left_anti"), df.join(large, keys, "left_semi"), int(n_rows)
    )


def scan_groups(df, keys, order, sums=None, prev=None, following=None) -> DataFrame:
    """One sort per group: inclusive running sums, value of the previous and of the next row."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {out: F.sum(c).over(upto) for out, c in (sums or {}).items()}
    columns |= {out: F.lag(c).over(ordered) for out, c in (prev or {}).items()}
    columns |= {out: F.lead(c).over(ordered) for out, c in (following or {}).items()}
    return df.withColumns(columns)


def scan_chunks(df, keys, order, n_rows, max_group_rows, sums=None, prev=None, following=None):
    """The same result as `scan_groups` for groups too large for one task.

    Values named in `prev` and `following` must not be null.
    """
    sums, prev, following = sums or {}, prev or {}, following or {}
    shared_folder(df.sparkSession)
    n_chunks = max(2, math.ceil(2 * n_rows / max_group_rows))
    # The chunk number comes from sampled range bounds, so it is written down before two
    # branches read it.
    chunks = (
        df.repartitionByRange(n_chunks, *keys, *order)
        .withColumn("_chunk", F.spark_partition_id())
        .checkpoint()
    )
    rank = F.struct(*order)
    totals = {f"_total_{out}": F.sum(c) for out, c in sums.items()}
    totals |= {f"_last_{out}": F.max_by(F.col(c), rank) for out, c in prev.items()}
    totals |= {f"_first_{out}": F.min_by(F.col(c), rank) for out, c in following.items()}
    cells = chunks.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_cell_rows"), *[v.alias(k) for k, v in totals.items()]
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_carry_{out}": F.sum(f"_total_{out}").over(before) for out in sums}
    carried |= {f"_carry_{out}": F.lag(f"_last_{out}").over(along) for out in prev}
    carried |= {f"_carry_{out}": F.lead(f"_first_{out}").over(along) for out in following}
    carry = cells.select(*keys, "_chunk", *[v.alias(k) for k, v in carried.items()])

    local = scan_groups(chunks, [*keys, "_chunk"], order, sums, prev, following)
    joined = local.join(carry, [*keys, "_chunk"])
    fixed = {out: F.col(out) + F.coalesce(f"_carry_{out}", F.lit(0)) for out in sums}
    fixed |= {out: F.coalesce(out, f"_carry_{out}") for out in [*prev, *following]}
    return joined.withColumns(fixed).drop("_chunk", *carried)


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, str] | None = None,
    prev: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add columns `out` for `{out: source column}`, along `order` within each group of `keys`."""
    sizes = split_by_group_size(df, keys, max_group_rows)
    small = scan_groups(sizes.small, keys, order, sums, prev, following)
    if sizes.large is None:
        return small
    large = scan_chunks(
        sizes.large, keys, order, sizes.large_rows, max_group_rows, sums, prev, following
    )
    return small.unionByName(large)

"""Causal per-user features over the trailing time window (t - window, t].

Among rows of equal time only those at or before the current row count, so the plain
`RANGE ... CURRENT ROW` frame, which takes in all peers, is not the wanted frame. The count is
the number of rows so far less the rows at or before t - window. A distinct count is kept the
same way without any set: a row *opens* its value if the value was absent from the window just
before, and *closes* it if the value does not come again within the window; values present are
the openings so far less the closings at or before t - window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventward.catalog import WINDOW_SECONDS
from eventward.functions.times import event_micros
from eventward.operators.ordered import (
    MAX_GROUP_ROWS,
    scan_chunks,
    scan_groups,
    split_by_group_size,
)
from eventward.session import shared_folder

USER = "subject_user_name"
ROLLING_COLUMNS = [
    "events_last_5min_user",
    "distinct_eventid_last_5min_user",
    "distinct_computers_last_5min_user",
    "seconds_since_prev_event_user",
]
NO_HOST = "\x00"


def _opens(prev: str, span: int) -> Column:
    return (F.col(prev).isNull() | (F.col("_us") - F.col(prev) >= span)).cast("long")


def _closes(following: str, span: int) -> Column:
    return (F.col(following).isNull() | (F.col(following) - F.col("_us") >= span)).cast("long")


def _with_marks(df: DataFrame, span: int) -> DataFrame:
    return df.withColumns(
        {
            "_open_e": _opens("_prev_e", span),
            "_close_e": _closes("_next_e", span),
            "_open_c": _opens("_prev_c", span),
            "_close_c": _closes("_next_c", span),
        }
    ).drop("_prev_e", "_next_e", "_prev_c", "_next_c")


def _rolling_in_windows(df: DataFrame, keys: list[str], order: list[str], span: int, dealt: bool) -> DataFrame:
    """One shuffle on the user serves all sorts, since each window groups by the user and more; a
    table that is bucketed by the user needs none."""
    df = df if dealt else df.repartition(keys[-1])
    df = scan_groups(df, [*keys, "event_id"], order, prev={"_prev_e": "_us"}, following={"_next_e": "_us"})
    df = scan_groups(df, [*keys, "_host"], order, prev={"_prev_c": "_us"}, following={"_next_c": "_us"})
    df = _with_marks(df, span)
    ordered = Window.partitionBy(*keys).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = Window.partitionBy(*keys).orderBy("_us").rangeBetween(Window.unboundedPreceding, -span)

    def present(entering: Column, leaving: Column) -> Column:
        return entering.over(upto) - F.coalesce(leaving.over(left), F.lit(0))

    one = F.lit(1)
    return df.select(
        "*",
        present(F.count(one), F.count(one)).alias(ROLLING_COLUMNS[0]),
        present(F.sum("_open_e"), F.sum("_close_e")).alias(ROLLING_COLUMNS[1]),
        present(F.sum("_open_c"), F.sum("_close_c")).alias(ROLLING_COLUMNS[2]),
        ((F.col("_us") - F.lag("_us").over(ordered)) / 1e6).alias(ROLLING_COLUMNS[3]),
    ).drop("_open_e", "_close_e", "_open_c", "_close_c")


def _rolling_in_chunks(df, keys, order, span, n_rows, max_group_rows) -> DataFrame:
    """Users too large for one task: openings and closings as one list of steps, summed in chunks."""
    shared_folder(df.sparkSession)
    rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    size = dict(n_rows=n_rows, max_group_rows=max_group_rows)
    narrow = rows.select(*keys, "event_id", "_host", *order, "_row")
    narrow = scan_chunks(narrow, [*keys, "event_id"], order, **size,
                         prev={"_prev_e": "_us"}, following={"_next_e": "_us"})
    narrow = scan_chunks(narrow, [*keys, "_host"], order, **size,
                         prev={"_prev_c": "_us"}, following={"_next_c": "_us"})
    narrow = scan_chunks(_with_marks(narrow, span), keys, order, **size, prev={"_prev": "_us"})
    enter = F.struct(
        F.col("_us").alias("_at"), F.lit(1).alias("_kind"), F.lit(1).cast("long").alias("_dn"),
        F.col("_open_e").alias("_de"), F.col("_open_c").alias("_dc"),
    )
    leave = F.struct(
        (F.col("_us") + span).alias("_at"), F.lit(0).alias("_kind"), F.lit(-1).cast("long").alias("_dn"),
        (-F.col("_close_e")).alias("_de"), (-F.col("_close_c")).alias("_dc"),
    )
    ties = order[1:]
    steps = narrow.select(
        *keys, *ties, "_row", "_us", "_prev", F.explode(F.array(enter, leave)).alias("_step")
    ).select(*keys, *ties, "_row", "_us", "_prev", "_step.*")
    steps = scan_chunks(
        steps, keys, ["_at", "_kind", *ties], 2 * n_rows, max_group_rows,
        sums={ROLLING_COLUMNS[0]: "_dn", ROLLING_COLUMNS[1]: "_de", ROLLING_COLUMNS[2]: "_dc"},
    )
    result = steps.where("_kind = 1").select(
        "_row", *ROLLING_COLUMNS[:3], ((F.col("_us") - F.col("_prev")) / 1e6).alias(ROLLING_COLUMNS[3])
    )
    return rows.join(result, "_row").drop("_row")


def add_rolling_features(
    df: DataFrame,
    group: tuple[str, ...] = ("split",),
    user: str = USER,
    seconds: int = WINDOW_SECONDS,
    ties: tuple[str, ...] = ("ord",),
    max_group_rows: int = MAX_GROUP_ROWS,
    dealt: bool = False,
) -> DataFrame:
    """Add the four rolling columns. Rows without user or time keep fixed values.

    `group` names columns whose values never share context, such as the split. `dealt` tells that
    the table is bucketed by the user (`write_layout`), so that only users too large for one task
    are shuffled.
    """
    span = seconds * 1_000_000
    keys = [*group, user]
    order = ["_us", *ties]
    has_group = F.col(user).isNotNull() & F.col("timestamp").isNotNull()
    host = F.coalesce("computer", F.lit(NO_HOST)) if "computer" in df.columns else F.lit(NO_HOST)
    grouped = df.where(has_group).withColumns({"_us": event_micros(), "_host": host})
    sizes = split_by_group_size(grouped, keys, max_group_rows)
    rolled = _rolling_in_windows(sizes.small, keys, order, span, dealt)
    if sizes.large is not None:
        large = _rolling_in_chunks(sizes.large, keys, order, span, sizes.large_rows, max_group_rows)
        rolled = rolled.unionByName(large)
    if "computer" not in df.columns:
        rolled = rolled.withColumn(ROLLING_COLUMNS[2], F.lit(0).cast("long"))
    defaults = [F.lit(1), F.lit(1), F.lit(0), F.lit(None).cast("double")]
    alone = df.where(~has_group).withColumns(
        {c: v if c == ROLLING_COLUMNS[3] else v.cast("long") for c, v in zip(ROLLING_COLUMNS, defaults)}
    )
    return rolled.drop("_us", "_host").unionByName(alone)

"""Related events on the same host, stratified samples and representative events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventward.catalog import PRIORITY_LABELS, RELATED_LIMIT, WINDOW_SECONDS
from eventward.functions.times import event_micros
from eventward.operators.ordered import MAX_GROUP_ROWS, ordered_scan
from eventward.session import stored

_KEY = ["computer", "_t", "_eid"]


def _moments(events: DataFrame, limit: int) -> DataFrame:
    """One row per host and time with the rows that can matter there, at most 2 * limit of them.

    A detection skips the rows of its own time and event id and shows `limit` rows. So of one
    event id at one time only the first `limit` rows can be shown, and of all rows of one time
    only the first 2 * limit of those, since a detection skips one event id at most.
    """
    rows = events.where("computer IS NOT NULL AND computer <> '' AND timestamp IS NOT NULL").select(
        "computer", event_micros().alias("us"), "ord", "event_id", "label"
    )
    per_id = Window.partitionBy("computer", "us", "event_id").orderBy("ord")
    per_time = Window.partitionBy("computer", "us").orderBy("ord")
    for window, keep in ((per_id, limit), (per_time, 2 * limit)):
        rows = rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= keep)
    return rows.groupBy("computer", "us").agg(
        F.array_sort(F.collect_list(F.struct("ord", "event_id", "label"))).alias("_rows")
    )


def related_events(
    events: DataFrame,
    detections: DataFrame,
    seconds: int = WINDOW_SECONDS,
    limit: int = RELATED_LIMIT,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """For each detection the first `limit` other events of its host within +- `seconds`.

    Every row with the detection's own time and event id is left out. Detections without host
    or time have no related events. `detections` needs ord, computer, timestamp and event_id.

    No pairs are formed. The times of a host are numbered in order, and the number of the first
    time inside the window is found by the same running count over the window starts. The
    answer lies in the next `limit` + 1 numbered times, each of which holds a row to show,
    but for the detection's own time. These are fetched by an equi join on blocks of numbers.
    """
    span = seconds * 1_000_000
    reach = limit + 1
    detections = detections.where(
        "computer IS NOT NULL AND computer <> '' AND timestamp IS NOT NULL"
    ).select("ord", "computer", event_micros().alias("_t"), F.col("event_id").alias("_eid"))
    moments = _moments(events, limit)
    wanted = detections.select(*_KEY).distinct()

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    marks = moments.select(
        "computer", F.col("us").alias("_at"), one.alias("_kind"), one.alias("_step"),
        "_rows", F.lit(None).cast("long").alias("_t"), F.lit(None).cast("int").alias("_eid"),
    ).unionByName(
        wanted.select(
            "computer", (F.col("_t") - span).alias("_at"), zero.alias("_kind"), zero.alias("_step"),
            F.lit(None).cast(moments.schema["_rows"].dataType).alias("_rows"), "_t",
            F.col("_eid").cast("int"),
        )
    )
    # Read three times below: group sizes, window starts and blocks.
    marks = stored(marks, "host-times")
    numbered = ordered_scan(
        marks, ["computer"], ["_at", "_kind"], sums={"_number": "_step"}, max_group_rows=max_group_rows
    )
    blocks = (
        numbered.where("_kind = 1")
        .withColumn("_block", F.expr(f"_number div {reach}"))
        .groupBy("computer", "_block")
        .agg(F.array_sort(F.collect_list(F.struct("_number", F.col("_at").alias("us"), "_rows"))).alias("_times"))
    )
    # Numbers _number + 1 .. _number + reach lie in two neighbouring blocks.
    starts = numbered.where("_kind = 0").select(
        *_KEY, F.col("_number").alias("_before"),
        F.explode(F.expr(f"array((_number + 1) div {reach}, (_number + 1) div {reach} + 1)")).alias("_block"),
    )
    in_window = (
        (F.col("_time._number") > F.col("_before"))
        & (F.col("_time._number") <= F.col("_before") + reach)
        & (F.col("_time.us") <= F.col("_t") + span)
    )
    candidates = (
        starts.join(blocks, ["computer", "_block"])
        .select(*_KEY, "_before", F.explode("_times").alias("_time"))
        .where(in_window)
        .select(*_KEY, F.col("_time.us").alias("us"), F.explode("_time._rows").alias("_row"))
        .where((F.col("us") != F.col("_t")) | ~F.col("_row.event_id").eqNullSafe(F.col("_eid")))
    )
    shown = (
        candidates.groupBy(*_KEY)
        .agg(F.array_sort(F.collect_list(F.struct("us", F.col("_row.ord").alias("related_ord"),
                                                  F.col("_row.event_id").alias("event_id"),
                                                  F.col("_row.label").alias("label")))).alias("_found"))
        .select(*_KEY, F.slice("_found", 1, limit).alias("_found"))
    )
    asked = detections.withColumn("_eid", F.col("_eid").cast("int")).alias("d")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in _KEY]  # an event id may be null
    return (
        asked.join(shown.alias("s"), same)
        .select("ord", F.posexplode("_found").alias("_pos", "_hit"))
        .select("ord", (F.col("_pos") + 1).alias("rank"), "_hit.*")
    )


def seeded_order(seed: int, column: str = "ord") -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(column).cast("string")))


def priority_sample(
    df: DataFrame, labels: list[str] = PRIORITY_LABELS, per_label: int = 2, limit: int = 12, seed: int = 42
) -> DataFrame:
    """A few random events of each priority label in list order, cut to `limit`, latest first.

    Without any event of these labels the sample is drawn from all events.
    """
    listed = df.where(F.col("label").isin(labels)).withColumn("_draw", seeded_order(seed))
    if listed.limit(1).isEmpty():
        drawn = df.withColumn("_draw", seeded_order(seed)).orderBy("_draw").limit(limit).drop("_draw")
    else:
        place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label"))
        within = Window.partitionBy("label").orderBy("_draw")
        drawn = (
            listed.withColumn("_rank", F.row_number().over(within))
            .where(F.col("_rank") <= per_label)
            .withColumn("_place", place)
            .orderBy("_place", "_rank")
            .limit(limit)
            .drop("_draw", "_rank", "_place")
        )
    return drawn.orderBy(F.desc_nulls_last("timestamp"), "ord")


def representative_events(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Per label the first event of its most frequent event id, if possible one with a user."""
    rows = df.where("label IS NOT NULL AND event_id IS NOT NULL")
    if labels is not None:
        rows = rows.where(F.col("label").isin(labels))
    counts = rows.groupBy("label", "event_id").agg(F.count(F.lit(1)).alias("_n"))
    common = counts.groupBy("label").agg(
        F.min_by("event_id", F.struct(-F.col("_n"), "event_id")).alias("_common")
    )
    first = Window.partitionBy("label").orderBy(F.col("subject_user_name").isNull(), "ord")
    return (
        rows.join(stored(common, "common-ids"), "label")
        .where("event_id = _common")
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank", "_common")
    )

"""Duplicate removal, leakage audit, profiling and label investigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventward.catalog import RARE_THRESHOLD
from eventward.functions.times import event_micros
from eventward.operators.ordered import MAX_GROUP_ROWS, ordered_scan
from eventward.session import stored

DEDUP_KEY = ("source_file", "record_id")


def deduplicate(df: DataFrame, key: tuple[str, ...] = DEDUP_KEY, ties: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Keep the first row of each key; rows whose last key column is null are all kept.

    Null ids become groups of their own, so they spread over the tasks. The rank filter is
    applied before the shuffle too, so a key copied many times sends one row per task.
    """
    alone = F.when(F.col(key[-1]).isNull(), F.struct(*ties))
    first = Window.partitionBy(*key, alone).orderBy(*ties)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def deduplication_report(df: DataFrame, key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """Rows before, rows after, rows removed and rows without an id."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    unkeyed = F.col(key[-1]).isNull()
    return counts.agg(
        F.sum("n").alias("rows_before"),
        F.sum(F.when(unkeyed, F.col("n")).otherwise(1)).alias("rows_after"),
        F.coalesce(F.sum(F.when(~unkeyed, F.col("n") - 1)), F.lit(0)).alias("removed"),
        F.coalesce(F.sum(F.when(unkeyed, F.col("n"))), F.lit(0)).alias("without_record_id"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def leakage_audit(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct hosts per label. Only a label bound to one host names it, so no host set is built."""
    hosts = F.approx_count_distinct("computer") if approximate else F.count_distinct("computer")
    audit = df.groupBy("label").agg(
        hosts.alias("n_hosts"), F.min("computer").alias("_host"), F.count(F.lit(1)).alias("n_events")
    )
    single = F.col("n_hosts") <= 1
    return audit.select(
        "label", "n_events", "n_hosts", single.alias("single_host"), F.when(single, F.col("_host")).alias("host")
    )


def label_distribution(df: DataFrame, limit: int | None = None) -> DataFrame:
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "label").limit(limit) if limit else counts


def label_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("label").alias("n_labels"))


def _null_figures(df: DataFrame, figure, value_name: str) -> DataFrame:
    """One pass over all columns, then one row per column."""
    wide = df.agg(*[figure(F.col(c)).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column_name", value_name).where(F.col(value_name) > 0)


def null_rates(df: DataFrame) -> DataFrame:
    return _null_figures(df, lambda c: F.round(F.avg(c.isNull().cast("double")) * 100, 6), "null_percent")


def null_counts(df: DataFrame) -> DataFrame:
    return _null_figures(df, lambda c: F.count_if(c.isNull()), "null_count")


def top_event_ids_per_label(df: DataFrame, n: int = 3) -> DataFrame:
    """The most frequent event ids of each label as text `id(count), ...` with the label size."""
    counts = df.groupBy("label", "event_id").agg(F.count(F.lit(1)).alias("n"))
    by_label = Window.partitionBy("label")
    ranked = counts.withColumns(
        {
            "n_events": F.sum("n").over(by_label),
            "rank": F.row_number().over(by_label.orderBy(F.desc("n"), "event_id")),
        }
    ).where(F.col("rank") <= n)
    text = F.concat(F.col("event_id").cast("string"), F.lit("("), F.col("n").cast("string"), F.lit(")"))
    return (
        ranked.groupBy("label")
        .agg(F.max("n_events").alias("n_events"), F.array_sort(F.collect_list(F.struct("rank", text.alias("t")))).alias("_top"))
        .select("label", "n_events", F.array_join(F.col("_top.t"), ", ").alias("event_ids"))
    )


def time_span_per_label(df: DataFrame) -> DataFrame:
    us = event_micros()
    return df.groupBy("label").agg(
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), (F.max(us) - F.min(us)).alias("span_us")
    )


def rare_labels(df: DataFrame, threshold: int = RARE_THRESHOLD) -> DataFrame:
    return label_distribution(df).where(F.col("n") < threshold)


def rare_label_totals(df: DataFrame, threshold: int = RARE_THRESHOLD) -> DataFrame:
    return rare_labels(df, threshold).agg(
        F.count(F.lit(1)).alias("n_labels"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_events")
    )


def merge_rare_labels(df: DataFrame, threshold: int = RARE_THRESHOLD) -> DataFrame:
    """Add `merged_label`: labels below the threshold become `rare_technique_<tactic>`."""
    rare = stored(rare_labels(df, threshold).select("label", F.lit(True).alias("_rare")), "rare-labels")
    merged = F.when(
        F.col("_rare") & F.col("mitre_tactic").isNotNull(),
        F.concat(F.lit("rare_technique_"), F.col("mitre_tactic")),
    ).otherwise(F.col("label"))
    return df.join(rare, "label", "left").withColumn("merged_label", merged).drop("_rare")


def tactic_distribution(df: DataFrame) -> DataFrame:
    return df.where("mitre_tactic IS NOT NULL").groupBy("mitre_tactic").agg(F.count(F.lit(1)).alias("n"))


def _of_labels(df: DataFrame, labels: list[str] | None) -> DataFrame:
    return df if labels is None else df.where(F.col("label").isin(labels))


def source_files_per_label(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    return _of_labels(df, labels).groupBy("label", "source_file").agg(F.count(F.lit(1)).alias("n"))


def days_per_label(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    day = F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    return _of_labels(df, labels).groupBy("label", day).agg(F.count(F.lit(1)).alias("n"))


def first_and_last_events(df: DataFrame, n: int = 15, labels: list[str] | None = None) -> DataFrame:
    """The first and the last `n` events of each label by time.

    Both rank filters also run before their shuffle, so no task sees a whole label.
    """
    rows = _of_labels(df, labels).withColumn("us", event_micros()).select(
        "label", "us", "ord", "source_file", "computer"
    )
    by_label = Window.partitionBy("label")

    def end(name: str, *order: Column) -> DataFrame:
        ranked = rows.withColumn("position", F.row_number().over(by_label.orderBy(*order)))
        return ranked.where(F.col("position") <= n).withColumn("which", F.lit(name))

    first = end("first", F.asc_nulls_last("us"), F.asc("ord"))
    last = end("last", F.desc_nulls_first("us"), F.desc("ord"))
    return first.unionByName(last).select(
        "label", "which", "position", "us", "ord", "source_file", "computer"
    )


def largest_gaps(
    df: DataFrame, n: int = 5, labels: list[str] | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The largest gaps between consecutive events of a label, with both positions."""
    rows = (
        _of_labels(df, labels)
        .where("label IS NOT NULL AND timestamp IS NOT NULL")
        .select("label", "ord", event_micros().alias("us"), F.lit(1).cast("long").alias("_one"))
    )
    scanned = ordered_scan(
        rows, ["label"], ["us", "ord"], sums={"_n": "_one"}, prev={"_prev": "us"},
        max_group_rows=max_group_rows,
    ).where("_prev IS NOT NULL")
    gaps = scanned.select(
        "label", (F.col("us") - F.col("_prev")).alias("gap_us"),
        (F.col("_n") - 2).alias("from_position"), (F.col("_n") - 1).alias("to_position"),
    )
    widest = Window.partitionBy("label").orderBy(F.desc("gap_us"), "to_position")
    return gaps.withColumn("rank", F.row_number().over(widest)).where(F.col("rank") <= n)


def mitre_coverage(df: DataFrame) -> DataFrame:
    """Rows without a tactic per split, and the labels they carry."""
    missing = F.col("mitre_tactic").isNull()
    return df.groupBy("split").agg(
        F.count_if(missing).alias("without_tactic"),
        F.count(F.lit(1)).alias("n_events"),
        F.array_join(F.array_sort(F.collect_set(F.when(missing, F.col("label")))), ",").alias("labels"),
    )


def tactics_per_label(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(
        F.array_join(F.array_sort(F.collect_set("mitre_tactic")), ",").alias("tactics")
    )


def describe_per_label(df: DataFrame, column: str, labels: list[str] | None = None,
                       accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, quartiles (linear) and extremes of a column per label.

    `accuracy` switches to approximate quartiles for columns with very many distinct values.
    """
    def quartile(q: float) -> Column:
        return F.percentile(column, q) if accuracy is None else F.percentile_approx(column, q, accuracy)

    return _of_labels(df, labels).groupBy("label").agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        quartile(0.25).alias("q25"),
        quartile(0.5).alias("q50"),
        quartile(0.75).alias("q75"),
        F.max(column).alias("max"),
    )


def top_mean_per_label(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    means = df.groupBy("label").agg(F.avg(column).alias("mean"))
    return means.orderBy(F.desc("mean"), "label").limit(n)

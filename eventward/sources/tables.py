"""Stored tables: event, split and feature tables, layouts for readers, label lists, previews."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eventward.operators.features import kept_columns
from eventward.session import prepare


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return prepare(spark).read.parquet(path)


def write_events(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Parquet and, on request, CSV with a header."""
    df.write.mode("overwrite").parquet(path)
    if csv_path:
        # From the written table, so that the events are computed once.
        df.sparkSession.read.parquet(path).write.mode("overwrite").csv(csv_path, header=True)


def write_split(df: DataFrame, path: str) -> None:
    """One table partitioned by split, so that reading one split opens only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    columns = [*kept_columns(df), "split"]
    df.select(*columns).write.mode("overwrite").partitionBy("split").parquet(path)


def write_label_list(labels: DataFrame, path: str) -> None:
    """One label per line, sorted; there are as many lines as labels."""
    labels.select("label").orderBy("label").coalesce(1).write.mode("overwrite").text(path)


def write_layout(events: DataFrame, path: str, key: str, order: tuple[str, ...] = ("timestamp", "ord"), buckets: int | None = None) -> str:
    """Write the event table for readers that go by a key: bucketed by it, sorted inside. Returns the table's name.

    Each bucket is one file. Windows and groups over the key read it without a shuffle, however
    often it is read; `spark.table(name)` is the table, for this session's catalog.
    """
    spark = events.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"layout_{uuid.uuid4().hex}"
    dealt = events.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(name, format="parquet")
    return name


def preview(df: DataFrame, n: int = 3, order: str = "ord") -> DataFrame:
    return df.orderBy(order).limit(n)

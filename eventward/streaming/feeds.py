"""Streaming forms of ingestion, duplicate removal and scoring; `keyed` has those that keep state by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.session import prepare, scratch_path
from eventward.sources.normalize import RAW, REASON


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New text lines of a folder with their file name and the start of their file block."""
    reader = prepare(spark).readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        "value",
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_name").alias("source_file"),
    )


def ingest_stream(
    lines: DataFrame, normalize: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
):
    """Normalise each micro-batch of `stream_lines` into one table, partitioned by `accepted`.

    Lines are numbered within the micro-batch, each file's lines in their order and no number
    twice. A repeated batch replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = normalize(batch.withColumn("ord", F.monotonically_increasing_id()).drop("_block"))
        with_quarantine(rows).write.mode("overwrite").partitionBy("accepted").parquet(f"{path}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), mode: str = "append"
):
    """Start an append-only table sink that takes all there is and stops."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def run_to_table(stream: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all available input into a fresh table of the shared folder; return it."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    query = write_stream(stream, path, checkpoint, partition_by)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def with_quarantine(normalized: DataFrame) -> DataFrame:
    """Accepted and rejected rows in one stream, told apart by `accepted`; raw text of rejects only."""
    ok = F.col(REASON).isNull()
    return normalized.withColumns({"accepted": ok, RAW: F.when(~ok, F.col(RAW))})


def deduplicate_stream(
    events: DataFrame, delay: str, key: tuple[str, ...] = ("source_file", "record_id")
) -> DataFrame:
    """Drop repeated keys within the watermark, and late rows; rows without a record id pass untouched.

    This is Spark's own form, without Python; `keyed.first_wins_stream` keeps what it drops. `delay` must cover the spread of event times over which copies arrive.
    """
    has_id = F.col(key[-1]).isNotNull()
    marked = events.withColumn("_event_time", F.col("timestamp").cast("timestamp"))
    kept = marked.where(has_id).withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(key))
    return kept.unionByName(marked.where(~has_id)).drop("_event_time")


def score_stream(events: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Score each micro-batch with the batch operator; a repeated batch replaces its own output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

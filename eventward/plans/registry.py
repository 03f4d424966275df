"""Versions of a detector in the shared folder, and scoring of a feed that takes up new ones."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.plans.detection import Detector, score_isolated

VERSION = "model_version"


class ModelRegistry:
    """Detectors under one path, each with its number; a version is there once its mark is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._loaded: tuple[int, Detector] | None = None

    def versions(self) -> list[int]:
        try:
            marks = self.spark.read.schema("number bigint").parquet(f"{self.path}/published")
            return sorted(row.number for row in marks.select("number").collect())
        except AnalysisException:  # nothing published yet
            return []

    def publish(self, detector: Detector) -> int:
        """Save the detector as the next version. Its mark comes last and is written once, so readers
        never see half a model, and of two writers of one number the second fails."""
        version = max(self.versions(), default=0) + 1
        detector.save(self.spark, self._folder(version))
        mark = self.spark.createDataFrame([(version,)], "number bigint").coalesce(1)
        mark.write.mode("error").parquet(f"{self.path}/published/mark={version}")
        return version

    def load(self, version: int) -> Detector:
        """The detector of a version; the one in use is kept and not read again."""
        if self._loaded is None or self._loaded[0] != version:
            self._loaded = version, Detector.load(self.spark, self._folder(version))
        return self._loaded[1]

    def _folder(self, version: int) -> str:
        return f"{self.path}/versions/{version}"


def score_with_latest(
    events: DataFrame, registry: ModelRegistry, path: str, checkpoint: str, columns: tuple[str, ...] = ("ord",)
):
    """Score each micro-batch of a feed with the newest version there is when it begins.

    A new version is taken up without a restart, and each row names its own in `model_version`.
    Rows come out as `columns` and the prediction, so events are not copied. Before anything is
    published the feed fails. A repeated batch replaces its own output, with one version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        found = registry.versions()
        if not found:
            raise ValueError(f"no detector published under {registry.path}")
        scored = score_isolated(batch, registry.load(found[-1])).select(
            *columns, "predicted_label", "predicted_tactic", "stage1_confidence", "stage2_confidence", "is_attack",
            F.lit(found[-1]).cast("bigint").alias(VERSION),
        )
        scored.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

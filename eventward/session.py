"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Event times are naive UTC, so the session must not shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_shipped: set[tuple[str, ...]] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Send packages to the Python workers, once per application, so that they need no install.

    The archive is made on the driver's own disk; Spark copies it to each executor.
    """
    context = spark.sparkContext
    key = (context.applicationId, *packages)
    if key in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="packages-"), f"{'-'.join(packages)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in packages:
            for folder, _, names in os.walk(os.path.join(top, package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)
    _shipped.add(key)


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    A cluster names it in `spark.checkpoint.dir`. Only a local session without that
    setting falls back to a temporary folder of the one machine it runs on.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="eventward-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside on leaving; results that read them must be written by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    This cuts the lineage, is computed once however often it is read, survives the loss of
    executors, and gives Spark the true size: a lookup table written this way is broadcast only
    if its files are below `spark.sql.autoBroadcastJoinThreshold`, and joined by shuffle if not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

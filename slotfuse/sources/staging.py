"""Tables written between stages, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own; on
    a cluster a missing setting is an error, since a folder of one machine would be
    lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="slotfuse-"))
    return context.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative learners cut their lineage in the shared folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back; the table goes when the session ends.

    For a result with several consumers: its inputs are read once, and a lost
    executor costs no more than the step that was running.
    """
    path = fresh_path(df.sparkSession, label)
    system, target = _file_system(df.sparkSession, path)
    system.deleteOnExit(target)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """`stage_table` for one job: what it wrote is deleted at the end, also on failure."""
    paths: list[str] = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        paths.append(fresh_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            system, target = _file_system(spark, path)
            system.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)

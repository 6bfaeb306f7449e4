"""Trees of sensor files: `<root>/<class>/<participant>/<CHANNEL>.csv`."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse import schemas

# Fixed value: keys in a reading's path, plain or as `key=value` folders, where the
# channel may be one file or a folder of part files.
PATH_KEYS = (
    r"/(?:class_id=)?(\d+)/(?:participant_id=)?(\d+)/(?:channel=)?(\w+?)(?:\.csv)?(?:/[^/]*)?$"
)


def _glob(root: str, channels: Iterable[str]) -> str:
    """All files of the channels; the two layouts lie at the same depth, a brace glob lists both at once."""
    names = [name for c in channels for name in (f"{c.upper()}.csv", f"channel={c}")]
    return f"{root.rstrip('/')}/*/*/{{{','.join(names)}}}"


def _reading_schema(time_type: str) -> str:
    return f"value {schemas.READING['value'].dataType.simpleString()}, Time {time_type}"


def read_readings(
    spark: SparkSession,
    root: str,
    channels: Iterable[str] = tuple(schemas.CHANNELS),
    time_type: str = "timestamp",
) -> DataFrame:
    """Readings of all named channels in one scan: value, Time, source.

    A channel without files adds no rows; without any file the table is empty. Cells
    that do not fit the schema are NULL. `source` is the path the keys are in.
    """
    schema = _reading_schema(time_type)
    try:
        readings = spark.read.schema(schema).option("mode", "PERMISSIVE").csv(_glob(root, channels))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, source string")
    return readings.select("value", "Time", F.col("_metadata.file_path").alias("source"))


def list_files(spark: SparkSession, root: str, channels: Iterable[str] = tuple(schemas.CHANNELS)) -> DataFrame:
    """source, modified, length of all files of the named channels; no content is read."""
    try:
        files = spark.read.format("binaryFile").load(_glob(root, channels))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "source string, modified timestamp, length bigint")
    return files.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )


def read_files(spark: SparkSession, sources: list[str], time_type: str = "timestamp") -> DataFrame:
    """`read_readings` of the named files alone, with `modified` and `length` of each."""
    paths = [unquote(s) for s in sources]  # the scan's metadata has them as URLs
    readings = spark.read.schema(_reading_schema(time_type)).option("mode", "PERMISSIVE").csv(paths)
    return readings.select(
        "value", "Time", F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_size").alias("length"),
    )


def path_keys(source: str = "source") -> list[Column]:
    """class_id, participant_id and channel of a path; no match gives NULL."""
    path = F.col(source)
    channel = F.lower(F.regexp_extract(path, PATH_KEYS, 3))
    return [
        F.regexp_extract(path, PATH_KEYS, 1).try_cast("int").alias("class_id"),
        F.regexp_extract(path, PATH_KEYS, 2).try_cast("int").alias("participant_id"),
        F.nullif(channel, F.lit("")).alias("channel"),
    ]


def with_path_keys(df: DataFrame, source: str = "source") -> DataFrame:
    """Replace `source` by the keys in it."""
    return df.select(*path_keys(source), *[c for c in df.columns if c != source])

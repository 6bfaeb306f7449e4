"""What several operators share: words, digests and tables staged between jobs."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse.sources.staging import fresh_path

BLANKS = " \t\n\x0b\x0c\r"
MAX_BROADCAST_BYTES = 32 << 20
BLANK_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of characters outside ASCII white space; NULL has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, BLANK_RUN))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` refers to it.

    Inside a higher-order function an expression would be computed for every element; a
    lambda's variable is not.
    """
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; NULL is empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back; it goes when the session ends.

    The lineage ends here, so a lost executor repeats one step and not all before it,
    and Spark knows the table's size when it chooses how to join it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).resolve().parent.parent
        name = os.path.join(tempfile.mkdtemp(prefix="slotfuse-ship-"), "slotfuse_ship")
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """`df` to be broadcast if its counted rows, at `row_bytes` each, stay within `limit`.

    Beyond the limit both sides are sorted and merged, which can spill. Counting runs a job.
    """
    return df.hint("broadcast" if df.count() * row_bytes <= limit else "merge")

"""Sensor slots kept up to date: files are read once, whenever they come.

A store holds the sums per file and slot of all files read so far, and a ledger of those
files. An update lists the tree, reads the files that the ledger does not know, and adds
their sums; slots are means over the sums of all files. Each update writes its sums first
and its ledger last, so one that was lost half-way leaves sums that no ledger names, and
the next update reads those files again. A file that was sent again replaces its former
sums, since the ledger's latest entry for its path alone counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotfuse import schemas
from slotfuse.operators.sensors import file_slot_sums, slots_of_sums
from slotfuse.sources.sensor_files import list_files, read_files
from slotfuse.sources.staging import path_exists

LEDGER = "source string, modified timestamp, length bigint, batch string"
FILE = ("source", "modified", "length")


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """Every file read so far as its latest version: source, modified, length, batch."""
    path = f"{store.rstrip('/')}/ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).parquet(path)
    latest = Window.partitionBy("source").orderBy(F.desc("modified"), F.desc("length"), F.desc("batch"))
    return entries.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")


def update_store(
    spark: SparkSession, wearable_dir: str, store: str, channels: Mapping[str, str] = schemas.CHANNELS, time_type: str = "timestamp"
) -> int:
    """Read the files that are new or were sent again; returns how many.

    Only the paths of those files come to the driver, which hands them to the scan.
    """
    listed = list_files(spark, wearable_dir, channels)
    known = ledger(spark, store).select(*FILE)
    fresh = listed.join(known, list(FILE), "left_anti").collect()
    if not fresh:
        return 0
    batch = uuid.uuid4().hex
    sums = file_slot_sums(read_files(spark, [r["source"] for r in fresh], time_type), False, "modified", "length")
    sums.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{store.rstrip('/')}/sums")
    rows = [(*[r[c] for c in FILE], batch) for r in fresh]
    spark.createDataFrame(rows, LEDGER).write.mode("append").parquet(f"{store.rstrip('/')}/ledger")
    return len(fresh)


def stored_slots(spark: SparkSession, store: str, channels: Mapping[str, str] = schemas.CHANNELS) -> DataFrame:
    """class_id, participant_id, slot and the means over all files of the store."""
    path = f"{store.rstrip('/')}/sums"
    if not path_exists(spark, path):
        empty = "class_id int, participant_id int, channel string, slot int, total double, n bigint"
        return slots_of_sums(spark.createDataFrame([], empty), channels)
    sums = spark.read.parquet(path)
    # One row a file meets some rows a file and slot; Spark sizes it.
    current = ledger(spark, store).select("source", "batch")
    return slots_of_sums(sums.join(current, ["source", "batch"]), channels)

"""Sensor slots and participant survey -> the analysis table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotfuse.functions.timeslots import clock_text, with_clock_seconds
from slotfuse.operators.prepare import impute_mean
from slotfuse.schemas import FUSED, MEANS

IMPUTED = ("eda_mean", "ibi_mean")


def join_slots(slots: DataFrame, participants: DataFrame) -> DataFrame:
    """Slots of a participant in a class with what they answered in that slot.

    Both sides have `slot` in seconds, so sensor slots stay where their aggregation
    left them. Answers lose their own copies of the keys.
    """
    answers = participants.withColumnRenamed("student_id", "participant_id")
    return slots.join(answers, ["class_id", "participant_id", "slot"], "inner").withColumnRenamed(
        "participant_id", "student_id"
    )


def fuse(
    slots: DataFrame, participants: DataFrame, imputed: Sequence[str] = IMPUTED
) -> DataFrame:
    """Join, impute over all rows including repeated ones, drop repeated rows.

    `participants` may be counted (`copies`). Rows are grouped with their number before
    they are used, once for the means and once for the result: both sides of the join
    are then shuffled once for both uses, and the grouping, which contains the join
    keys, adds no exchange.
    """
    if "copies" not in participants.columns:
        participants = participants.withColumn("copies", F.lit(1).cast("long"))
    keys = ["class_id", "student_id", "slot"]
    carried = ["room", "gender_code", "age", *MEANS, "engagement_level"]
    rows = join_slots(slots, participants).groupBy(*keys, *carried).agg(
        F.sum("copies").alias("copies")
    )
    # The filter keeps `copies` in the plan here as well, so the two uses stay alike.
    filled = impute_mean(rows.where(F.col("copies") > 0), imputed, copies="copies")
    distinct = filled.select(*keys, *carried).distinct()
    return distinct.withColumn("timestamp", clock_text(F.col("slot"))).select(*FUSED.names)


def fuse_tables(slots: DataFrame, participants: DataFrame) -> DataFrame:
    """`fuse` for the two tables as they are stored, with times as text."""
    return fuse(
        with_clock_seconds(slots, "time_format", "slot"),
        with_clock_seconds(participants, "time", "slot"),
    )

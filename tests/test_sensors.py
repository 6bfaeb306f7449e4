from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from slotfuse.functions.timeslots import slot_of_day
from slotfuse.operators import sensors
from slotfuse.schemas import CHANNELS

KEYS = ["class_id", "participant_id", "slot"]
START = datetime(2024, 1, 1, 9, 20)


@pytest.fixture
def readings(spark):
    data = []
    for i in range(300):
        channel = ["hr", "temp", "eda", "ibi"][i % 4]  # bvp has none
        person = None if i % 37 == 0 else i % 5
        data.append((1 + i % 2, person, channel, START + timedelta(seconds=23 * i), float(i)))
    schema = "class_id int, participant_id int, channel string, Time timestamp, value double"
    df = spark.createDataFrame(data, schema)
    return df.withColumn("slot", slot_of_day(F.col("Time")))


def by_channel(readings):
    return {
        name: sensors.slot_means(
            readings.where(F.col("channel") == c), KEYS[:2], F.col("slot"), "value", name
        )
        for c, name in CHANNELS.items()
    }


def test_merging_equals_a_fold_of_outer_joins(readings, rows):
    frames = by_channel(readings)
    fold = reduce(lambda a, b: a.join(b, KEYS, "outer"), frames.values())
    merged = sensors.merge_channels(frames, KEYS)
    assert merged.columns == fold.columns
    assert rows(merged) == rows(fold)


def test_single_pass_equals_merging(readings, rows):
    wide = sensors.wide_slot_means(readings, KEYS, CHANNELS)
    assert rows(wide) == rows(sensors.merge_channels(by_channel(readings), KEYS))
    assert wide.where(F.col("bvp_mean").isNotNull()).count() == 0


def test_without_strays_only_full_keys_are_left(readings, rows):
    kept = sensors.wide_slot_means(readings, KEYS, CHANNELS).na.drop(subset=KEYS)
    assert rows(sensors.wide_slot_means(readings, KEYS, CHANNELS, keep_stray=False)) == rows(kept)


def test_single_pass_needs_one_exchange(readings):
    plan = sensors.wide_slot_means(readings, KEYS, CHANNELS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_means_lie_within_the_readings(readings):
    lone = readings.where(F.col("channel") == "hr")
    ends = lone.groupBy(*KEYS).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    means = sensors.slot_means(lone, KEYS[:2], F.col("slot"), "value", "mean")
    assert means.join(ends, KEYS).where((F.col("mean") < F.col("lo")) | (F.col("mean") > F.col("hi"))).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_dense_slots_fill_each_keys_own_span(spark, rows, kind):
    data = [("a", START, 1.0), ("a", START + timedelta(seconds=60), 3.0), ("a", START + timedelta(minutes=16), 5.0),
            ("b", START + timedelta(days=1), 7.0)]
    df = spark.createDataFrame(data, "k string, t timestamp, v double").withColumn("t", F.col("t").cast(kind))
    dense = sensors.dense_slots(df, ["k"], "t", "v", "mean")
    step = timedelta(minutes=5)
    assert rows(dense) == [
        ("a", START, 2.0), ("a", START + step, None), ("a", START + 2 * step, None), ("a", START + 3 * step, 5.0),
        ("b", START + timedelta(days=1), 7.0),
    ]


def test_dense_without_empty_slots_is_sparse(readings, rows):
    hr = readings.where((F.col("channel") == "hr") & F.col("participant_id").isNotNull())
    dense = sensors.dense_slots(hr, KEYS[:2], "Time", "value", "mean").where(F.col("mean").isNotNull())
    sparse = sensors.slot_means(hr, KEYS[:2], F.window("Time", "5 minutes")["start"].alias("slot_start"), "value", "mean")
    assert rows(dense) == rows(sparse)

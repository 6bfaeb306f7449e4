from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slotfuse.functions import answers, timeslots


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "text, slot, clock",
    [
        ("2019-09-04 09:24:59.9", 33600, "09:20:00"),
        ("2019-09-04 09:25:00", 33900, "09:25:00"),
        ("2019-09-04 00:00:00", 0, "00:00:00"),
        ("2019-09-04 23:59:59", 86100, "23:55:00"),
    ],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_slot_of_day(spark, text, slot, clock, kind):
    df = spark.range(1).select(F.lit(text).cast(kind).alias("t"))
    s = timeslots.slot_of_day(F.col("t"))
    row = df.select(s, timeslots.clock_text(s), timeslots.clock_seconds(timeslots.clock_text(s))).first()
    assert tuple(row) == (slot, clock, slot)


@pytest.mark.parametrize("width", [1, 7, 45, 60, 90, 300, 1800, 3600, 7200])
def test_slots_of_any_width(spark, width):
    times = spark.sql("select timestamp_seconds(id * 601 + 0.5) as t, id * 601 % 86400 as s from range(300)")
    slots = times.select(timeslots.slot_of_day(F.col("t"), width).alias("slot"), "s")
    assert slots.where(F.col("slot") != F.col("s") - F.col("s") % width).count() == 0


def test_slots_do_not_depend_on_the_date(spark):
    days = spark.createDataFrame([(f"20{y}-0{m}-17 10:07:30",) for y in (19, 24) for m in (1, 7)], "t string")
    slots = days.select(timeslots.slot_of_day(F.col("t").cast("timestamp"))).distinct()
    assert [r[0] for r in slots.collect()] == [36300]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_floor_to_slot_rounds_down_before_1970_too(spark, kind):
    df = spark.createDataFrame(
        [("1969-12-31 23:58:30.25",), ("2024-01-01 00:04:59.999999",), ("2024-01-01 00:05:00",), (None,)], "t string"
    ).select(F.col("t").cast(kind).alias("t"))
    floored = df.select(timeslots.floor_to_slot(F.col("t")).alias("f"))
    assert floored.schema["f"].dataType.simpleString() == kind
    assert [r[0] for r in floored.collect()] == [
        datetime(1969, 12, 31, 23, 55),
        datetime(2024, 1, 1, 0, 0),
        datetime(2024, 1, 1, 0, 5),
        None,
    ]


def test_clock_seconds_of_bad_text_is_null(spark):
    df = spark.createDataFrame([("9:20:00",), ("late",), ("09:20",), (None,)], "t string")
    assert [r[0] for r in df.select(timeslots.clock_seconds(F.col("t"))).collect()] == [33600, None, None, None]


def test_minutes_between(spark):
    df = spark.sql("select timestamp'2024-01-01 09:00:00' a, timestamp'2024-01-01 10:20:33' b")
    assert one(df.select(timeslots.minutes_between(F.col("a"), F.col("b")))) == 80.6


def test_likert_scores(spark):
    texts = [*answers.LIKERT_SCORES, answers.MISSING, "strongly agree", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
    got = [r[0] for r in df.orderBy("i").select(answers.likert_score("a")).collect()]
    assert got == [2, 1, 0, -1, -2, 0, 0, 0]


def test_level_counts_a_zero_total_as_engaged(spark):
    df = spark.createDataFrame(
        [("Strongly agree", "Strongly disagree"), ("Somewhat agree", "Strongly disagree"), (None, None)],
        "a string, b string",
    )
    total = answers.likert_total(["a", "b"])
    got = df.select(total, answers.likert_average(["a", "b"]), answers.engagement_level(total)).collect()
    assert [tuple(r) for r in got] == [(0, 0.0, "Engaged"), (-1, -0.5, "Not Engaged"), (0, 0.0, "Engaged")]


def test_binary_code_gives_one_to_null(spark):
    df = spark.createDataFrame([("female",), ("male",), (None,)], "g string")
    assert [r[0] for r in df.select(answers.binary_code("g", "female")).collect()] == [0, 1, 1]


def test_list_items_keep_blanks_unless_trimmed(spark):
    df = spark.createDataFrame([("shirt, scarf",), (None,)], "c string")
    assert [r[0] for r in df.select(answers.list_items("c")).collect()] == ["shirt", " scarf"]
    assert [r[0] for r in df.select(answers.list_items("c", trim=True)).collect()] == ["shirt", "scarf"]

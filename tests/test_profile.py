import math

import pytest
from pyspark.sql import functions as F

from slotfuse.operators import profile


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [(1.0, 2.0, 5.0, 1), (2.0, 4.1, 5.0, None), (3.0, None, 5.0, 2), (4.0, 8.3, 5.0, 2), (float("nan"), 1.0, 5.0, None)],
        "a double, b double, flat double, g int",
    )


def test_null_profiles_differ_on_an_empty_table(numbers):
    assert tuple(profile.null_sums(numbers).first()) == (0, 1, 0, 2)
    assert tuple(profile.null_counts(numbers).first()) == (0, 1, 0, 2)
    empty = numbers.where("a > 100 and not isnan(a)")
    assert tuple(profile.null_sums(empty).first()) == (None,) * 4
    assert tuple(profile.null_counts(empty).first()) == (0,) * 4


def test_null_is_a_group_but_not_a_value(numbers, rows):
    assert rows(profile.group_count(numbers, "g")) == [(None, 2), (1, 1), (2, 2)]
    assert rows(profile.value_counts(numbers, "g")) == [(1, 1), (2, 2)]
    assert rows(profile.distinct_per_group(numbers, "g", "flat", "n")) == [(1, 1), (2, 1)]


def test_distinct_count_counts_null_once(numbers, spark):
    assert profile.distinct_count(numbers, "g", "n").first()[0] == 3
    assert profile.distinct_count(numbers, "flat", "n").first()[0] == 1
    assert profile.distinct_count(spark.createDataFrame([], "g int"), "g", "n").first()[0] == 0


def test_empty_cells_of_a_pivot_are_null(spark, rows):
    df = spark.createDataFrame([("f", "x"), ("f", "x"), ("m", "y"), ("m", None)], "s string, a string")
    assert rows(profile.pivot_counts(df, "s", "a"), "s", "x", "y", "null") == [("f", 2, None, None), ("m", None, 1, 1)]
    assert rows(profile.pivot_counts(df, "s", "a", ["x"])) == [("f", 2, None), ("m", None, 2)]
    grouped = profile.group_count(df, "s", "a", name="n")
    assert rows(profile.pivot_grouped(grouped, "s", "a", "n"), "s", "x", "y", "null") == [("f", 2, None, None), ("m", None, 1, 1)]


def test_correlation_skips_nulls_pairwise_and_constant_columns(numbers):
    got = {r["column"]: r for r in profile.correlation_matrix(numbers, ["a", "b", "flat"]).collect()}
    xs, ys = [1.0, 2.0, 4.0], [2.0, 4.1, 8.3]
    mx, my = sum(xs) / 3, sum(ys) / 3
    r = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(
        sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys)
    )
    assert got["a"]["b"] == pytest.approx(r) == got["b"]["a"]
    assert got["a"]["a"] == 1.0
    assert got["flat"]["a"] is None and got["flat"]["flat"] is None


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (4.0, 7)], "x double, y int")
    got = {r["column"]: tuple(r)[1:] for r in profile.describe(df, ["x", "y"]).collect()}
    assert got["y"] == (2, 6.0, pytest.approx(math.sqrt(2)), 5.0, 7.0)
    assert got["x"][0] == 3 and got["x"][3:] == (1.0, 4.0)


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 12, 12, 11.9, 6)] + [(None,)], "v double")
    got = [tuple(r) for r in profile.histogram(df, "v", 12).orderBy("bin").collect()]
    assert [n for *_, n in got] == [1, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 3]
    assert got[0][1:3] == (0.0, 1.0) and got[11][2] == 12.0


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(5,), (5,)], "v int")
    got = [tuple(r) for r in profile.histogram(df, "v", 12).orderBy("bin").collect()]
    assert got[0][1] == 4.5 and got[11][2] == 5.5
    assert [n for *_, n in got] == [0] * 6 + [2] + [0] * 5


def test_band_of_one_value_has_no_width(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 1.0), (2, 3.0)], "h int, v double")
    got = {r["h"]: r for r in profile.mean_band(df, "h", "v").collect()}
    assert got[1]["mean"] == 4.0 and got[1]["lower"] is None
    assert got[2]["upper"] == pytest.approx(2 + 1.96)


def test_trend_filters_one_participant(spark, rows):
    df = spark.createDataFrame([(3, "09:25:00", 2.0), (3, "09:20:00", 1.0), (4, "09:20:00", 9.0)],
                               "participant_id int, time_format string, hr_mean double")
    got = [tuple(r) for r in profile.participant_trend(df, F.lit(3), "hr_mean").collect()]
    assert got == [("09:20:00", 1.0), ("09:25:00", 2.0)]


def test_a_pivot_loses_no_row(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("a", None)], "k string, v string")
    assert rows(profile.pivot_counts(df, "k", "v", ["x"]), "x", "other") == [(1, 3)]
    assert sum(rows(profile.pivot_counts(df, "k", "v").drop("k"))[0]) == 4

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.operators import conform, prepare
from slotfuse.operators.report import classification_report


def test_impute_counts_copies_and_treats_nan_as_missing(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, None, 3), (2, 5.0, None, 1), (3, None, None, 7), (4, float("nan"), None, 2)],
        "id int, x double, none double, copies long",
    )
    got = rows(prepare.impute_mean(df, ["x", "none"], copies="copies").select("id", "x", "none"))
    assert got == [(1, 1.0, None), (2, 5.0, None), (3, 2.0, None), (4, 2.0, None)]
    plain = rows(prepare.impute_mean(df, ["x"]).select("id", "x"))
    assert plain[2] == (3, 3.0)


def test_impute_can_be_fitted_on_another_table(spark, rows):
    train = spark.createDataFrame([(2.0,), (4.0,)], "x double")
    test = spark.createDataFrame([(None,), (9.0,)], "x double")
    assert rows(prepare.impute_mean(test, ["x"], fit_on=train)) == [(3.0,), (9.0,)]


def test_standardise_uses_population_deviation(spark, rows):
    df = spark.createDataFrame([(1.0, 7.0, None), (3.0, 7.0, None)], "x double, flat double, none double")
    assert rows(prepare.standardise(df, ["x", "flat", "none"])) == [(-1.0, 0.0, None), (1.0, 0.0, None)]
    other = spark.createDataFrame([(5.0, 9.0, 1.0)], df.schema)
    assert rows(prepare.standardise(other, ["x", "flat", "none"], fit_on=df)) == [(3.0, 2.0, None)]


def test_split_is_a_partition_and_stable(spark, rows):
    df = spark.range(2000).withColumn("text", F.concat(F.lit("r"), F.col("id")))
    train, test = prepare.hash_split(df, ["id", "text"])
    assert rows(train.union(test)) == rows(df)
    assert train.join(test, "id").count() == 0
    assert 1500 < train.count() < 1700
    again, _ = prepare.hash_split(df.repartition(7), ["id", "text"])
    assert rows(again) == rows(train)


def test_conform_takes_columns_by_name_and_nulls_bad_cells(spark, rows):
    df = spark.createDataFrame([("0", "12", "a"), ("1", "x", "b")], "_c0 string, AGE string, name string")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    got = conform.conform(df, schema)
    assert got.schema == schema
    assert rows(got) == [("a", 12), ("b", None)]


def test_parse_readings_drops_what_does_not_parse(spark):
    df = spark.createDataFrame(
        [("1.5", "2024-01-01 09:00:00"), ("x", "2024-01-01 09:00:00"), ("2", "soon"), (None, None)], "v string, t string"
    )
    assert [r["v"] for r in conform.parse_readings(df, "v", "t").collect()] == [1.5]


def test_features_are_the_training_tables_numbers(spark):
    train = spark.createDataFrame([(1, 2.0, "x", "Engaged")], "class_id int, hr double, room string, y string")
    test = train.select("y", "hr", "class_id", "room")
    a, b, features = conform.features_and_label(train, test, "y", leave_out=["class_id"])
    assert features == ["hr"] and a.columns == b.columns == ["hr", "y"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "Pid int, Week int")
    assert conform.lower_names(conform.rename(df, {"pid": "student_id"})).columns == ["student_id", "week"]
    assert conform.with_constants(df, {"c": 4}).first()["c"] == 4


def test_report(spark):
    pairs = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] * 1 + [("b", "a")] * 3 + [("c", "a")]
    df = spark.createDataFrame(pairs, "y string, p string")
    got = {r["row"]: tuple(r)[1:] for r in classification_report(df, "y", "p").collect()}
    assert got["a"] == (pytest.approx(0.6), pytest.approx(0.75), pytest.approx(2 / 3), 8)
    assert got["b"] == (pytest.approx(1 / 3), 0.25, pytest.approx(2 / 7), 4)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][:3] == (pytest.approx(7 / 13),) * 3
    assert got["macro avg"][1] == pytest.approx(1 / 3) and got["macro avg"][3] == 13
    assert got["weighted avg"][0] == pytest.approx((0.6 * 8 + 4 / 3) / 13)


def test_part_column_is_the_split(spark, rows):
    df = spark.range(200).selectExpr("id", "id % 7 as x")
    train, test = prepare.hash_split(df, ["id"], 70)
    parts = df.withColumn("part", prepare.split_part(["id"], 70))
    assert rows(parts.where("part = 'train'"), "id", "x") == rows(train)
    assert rows(parts.where("part = 'test'"), "id", "x") == rows(test)

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse import schemas
from slotfuse.functions.timeslots import with_clock_text
from slotfuse.operators.sensors import sensor_slots
from slotfuse.sources import sensor_files, staging, tables


def tree(root, files):
    for path, lines in files.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("\n".join(lines) + "\n")
    return str(root)


@pytest.fixture
def wearables(tmp_path):
    return tree(
        tmp_path / "anything",
        {
            "1/3/HR.csv": ["90,2019-09-04 09:20:01", "110,2019-09-04 09:24:59", "80,2019-09-04 09:25:00"],
            "1/3/TEMP.csv": ["18.5,2019-09-04 09:20:30", "warm,2019-09-04 09:20:31", "19.5,never"],
            "1/12/HR.csv": ["70,2019-09-05 09:21:00"],
            "2/3/IBI.csv": [],
            "2/3/notes.csv": ["1,2019-09-04 09:20:00"],
            "2/3/deep/HR.csv": ["1,2019-09-04 09:20:00"],
        },
    )


def test_readings_of_a_tree(spark, wearables, rows):
    df = sensor_files.with_path_keys(sensor_files.read_readings(spark, wearables))
    counts = df.groupBy("class_id", "participant_id", "channel").count()
    assert rows(counts) == [(1, 3, "hr", 3), (1, 3, "temp", 3), (1, 12, "hr", 1)]
    bad = df.where(F.col("channel") == "temp").select("value", F.col("Time").isNull())
    assert rows(bad) == [(None, False), (18.5, False), (19.5, True)]


def test_slots_of_a_tree(spark, wearables, rows):
    slots = with_clock_text(
        sensor_slots(sensor_files.read_readings(spark, wearables), schemas.CHANNELS), "slot", "time_format"
    )
    assert slots.columns == schemas.SENSOR_SLOTS.names
    assert rows(slots, "class_id", "participant_id", "time_format", "hr_mean", "temp_mean", "bvp_mean") == [
        (1, 3, "09:20:00", 100.0, 18.5, None),
        (1, 3, "09:25:00", 80.0, None, None),
        (1, 12, "09:20:00", 70.0, None, None),
    ]


@pytest.mark.parametrize("names", [["gsr"], list(schemas.CHANNELS)])
def test_no_file_at_all_gives_an_empty_table(spark, tmp_path, names):
    df = sensor_files.read_readings(spark, str(tmp_path / "nowhere"), names)
    assert df.columns == ["value", "Time", "source"] and df.count() == 0
    assert sensor_slots(df, schemas.CHANNELS).count() == 0


def test_other_read_errors_are_not_swallowed(spark):
    with pytest.raises(Exception):
        sensor_files.read_readings(spark, "nosuchscheme://x/y").count()


def test_headed_csv_is_read_by_name(spark, tmp_path, rows):
    file = tmp_path / "class_table.csv"
    file.write_text(
        ",room,Class_id,Start_time,Finish_time,Week,Weekday,Class_no,Class_len,Subject,is_Form\n"
        "0,R1,7,2019-09-04 09:20:00,2019-09-04 10:40:00,1,2,3,long,Maths,yes\n"
        "1,R2,x,09:20:00,,1,2,3,long,Maths,no\n"
    )
    df = tables.read_table(spark, str(file), schemas.CLASS_TABLE)
    assert df.schema == schemas.CLASS_TABLE
    got = rows(df.select("Class_id", "Room", F.hour("Start_time"), F.minute("Finish_time"), "is_Form"))
    assert got == [(None, "R2", 9, None, "no"), (7, "R1", 9, 40, "yes")]


def test_headings_with_dots_are_read(spark, tmp_path):
    file = tmp_path / "student.csv"
    heads = schemas.STUDENT.names
    file.write_text(",".join(f'"{h}"' for h in heads) + "\n" + "1,female,13,A,B,C,4,yes,no\n")
    row = tables.read_table(spark, str(file), schemas.STUDENT).first()
    assert tuple(row) == (1, "female", 13, "A", "B", "C", 4, "yes", "no")


@pytest.mark.parametrize("name", ["t.csv", "t"])
def test_tables_survive_a_round_trip(spark, tmp_path, rows, name):
    df = spark.sql(
        """select * from values (1, 'a,"b"', 0.1D, timestamp_ntz'2024-01-01 00:00:07.179575'),
        (2, null, null, null), (3, 'c', 1e-9D, timestamp_ntz'1969-12-31 23:59:59') as t(i, s, d, t)"""
    )
    path = str(tmp_path / name)
    tables.write_table(df, path)
    tables.write_table(df, path)
    assert rows(tables.read_table(spark, path, df.schema)) == rows(df)


def test_partitioned_write(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "class_id int, hr_mean double")
    tables.write_table(df, str(tmp_path / "p"), partition_by=["class_id"])
    assert (tmp_path / "p" / "class_id=1").is_dir()
    assert rows(spark.read.parquet(str(tmp_path / "p")), "class_id", "hr_mean") == rows(df)


def test_staged_tables_lie_in_the_shared_folder(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda session: str(tmp_path))
    df = spark.range(5).selectExpr("id", "id % 2 as odd")
    assert rows(staging.stage_table(df, "part")) == rows(df)
    assert [p.name.startswith("part-") for p in tmp_path.iterdir()] == [True]


class _Cluster:
    """Stands for a session on a cluster that names no shared folder."""

    master = "spark://host:7077"
    conf = property(lambda self: self)
    sparkContext = property(lambda self: self)
    getCheckpointDir = staticmethod(lambda: None)

    def __init__(self, **settings):
        self.settings = settings

    def get(self, key, default):
        return self.settings.get(key, default)


def test_the_session_names_the_shared_folder():
    assert staging.shared_folder(_Cluster(**{"spark.checkpoint.dir": "hdfs:///tmp/x/"})) == "hdfs:///tmp/x"


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        staging.shared_folder(_Cluster())


def test_a_local_session_gets_a_folder_of_its_own(spark):
    assert staging.shared_folder(spark) == staging.shared_folder(spark)


def test_csv_gives_back_any_text(spark, tmp_path):
    from slotfuse.sources.tables import read_csv_as_written, read_table, write_table

    texts = ["two\nlines", 'a "quote", a comma', "", None, " blanks ", "back\\slash", "r\r\nn", "\u241b", "\u241bn \u241be\n\u241br", "\\N"[1:]]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    path = str(tmp_path / "t.csv")
    write_table(df, path)
    for back in (read_csv_as_written(spark, path, df.schema), read_table(spark, path, df.schema)):
        assert {r["n"]: r["t"] for r in back.collect()} == dict(enumerate(texts))


def test_whole_numbers_with_a_point_stay_whole(spark):
    from pyspark.sql import types as T

    from slotfuse.operators.conform import conform

    df = spark.createDataFrame([("13.0",), ("1e1",), ("7",), ("7.5",), ("",), ("x",), (None,)], "Age string")
    schema = T.StructType([T.StructField("Age", T.IntegerType())])
    assert [r["Age"] for r in conform(df, schema).collect()] == [13, 10, 7, None, None, None, None]


def test_large_csv_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    df = spark.range(20_000).selectExpr("id", "concat('line ', id, '\\n', repeat('x', 50)) as t")
    tables.write_table(df.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        back = tables.read_csv_as_written(spark, path, df.schema)
        assert back.rdd.getNumPartitions() > 3
        assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_foreign_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,t\n1,"two\nlines"\n2,one\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("t", T.StringType())])
    rows = tables.read_table(spark, str(tmp_path / "f.csv"), schema, multiline=True).collect()
    assert sorted(map(tuple, rows)) == [(1, "two\nlines"), (2, "one")]

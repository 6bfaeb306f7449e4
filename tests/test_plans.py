"""The three stages from raw files to metrics, and the fusion by itself."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slotfuse import schemas
from slotfuse.plans import fusion, jobs, survey, training
from slotfuse.plans.boosting import BoostedTrees
from slotfuse.schemas import FUSED, MEANS, PARTICIPANT_SURVEY
from slotfuse.sources import staging
from slotfuse.sources.tables import read_table
from test_sources import tree

TEXTS = ["Strongly agree", "Somewhat agree", "Neither agree nor disagree", "Somewhat disagree", "Strongly disagree"]
PEOPLE = range(1, 13)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Twelve participants, two overlapping classes a day in week 1, two days."""
    root = tmp_path_factory.mktemp("raw")
    rng = random.Random(5)
    heads = ",".join(f'"{h}"' for h in schemas.STUDENT.names)
    students = [heads] + [f"{p},{'female' if p % 2 else 'male'},{12 + p % 3},A,B,C,3,x,y" for p in PEOPLE]
    students.append("99,,,A,B,C,3,x,y")
    classes = [",".join(schemas.CLASS_TABLE.names)] + [
        f"{d * 2 + k + 1},R{k},2019-09-0{2 + d} 09:{k * 20:02d}:00,2019-09-0{2 + d} 10:00:00,long,1,{d},1,Maths,no"
        for d in (0, 1)
        for k in (0, 1)
    ] + ["50,R9,2019-09-02 09:00:00,2019-09-02 10:00:00,long,7,0,1,Maths,no"]
    answers, files = [",".join(schemas.STUDENT_SURVEY.names)], {}
    for p in PEOPLE:
        for d in (0, 1):
            for m in (22, 22, 43):
                mood = rng.choice(TEXTS + [""])
                cells = ",".join([mood] * 5)
                answers.append(f'{p},1,{d},2019-09-0{2 + d} 09:{m}:30,1,Cooler,"shirt,scarf",1,2,{cells},1,1,1')
                mean = 80 if "dis" not in mood else 120
            for k in (0, 1):
                start = datetime(2019, 9, 2 + d, 9, 0)
                for code in schemas.CHANNELS:
                    if code == "ibi" and p % 3 == 0:
                        continue
                    files[f"wearables/{d * 2 + k + 1}/{p}/{code.upper()}.csv"] = [
                        f"{mean + rng.random():.3f},{start + timedelta(seconds=75 * i)}" for i in range(48)
                    ]
    files |= {"people/student.csv": students, "people/class_table.csv": classes, "survey/student_survey.csv": answers}
    return tree(root, files)


@pytest.fixture(scope="module")
def fused(spark, raw):
    jobs.fuse(spark, f"{raw}/people", f"{raw}/survey/", f"{raw}/people", f"{raw}/wearables", f"{raw}/out/fused.csv")
    return f"{raw}/out/fused.csv"


def test_fuse_leaves_no_staged_table(spark, raw, monkeypatch, tmp_path):
    monkeypatch.setattr("slotfuse.sources.staging.shared_folder", lambda _: str(tmp_path))
    people = (f"{raw}/people", f"{raw}/survey", f"{raw}/people", f"{raw}/wearables")
    jobs.fuse(spark, *people, f"{raw}/out/again.csv")
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(RuntimeError), staging.staging(spark) as stage:
        assert stage(spark.range(3), "x").count() == 3
        raise RuntimeError
    assert list(tmp_path.iterdir()) == []


def test_stages_take_the_project_first_or_by_name():
    plain = jobs._arguments(["prepare", "a", "b", "c"])
    assert (plain.leading_project, plain.fused, plain.test_out, plain.train_share) == (None, "a", "c", 80)
    first = jobs._arguments(["prepare", "p", "a", "b", "c", "--train-share", "70"])
    assert (first.leading_project, first.fused, first.test_out, first.train_share) == ("p", "a", "c", 70)
    whole = jobs._arguments(["fuse", "p", "a", "b", "c", "d", "e"])
    assert (whole.leading_project, whole.participant_dir, whole.out) == ("p", "a", "e")


def test_fusion_join_splits_a_hot_slot(spark):
    """On staged slots, a slot that holds most answers is split, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        keys = ("1 as class_id", "cast(id as int) as participant_id", "0 as slot")
        slots = staging.stage_table(spark.range(50).selectExpr(*keys, "1.0 as hr_mean"), "slots")
        hot = "cast(case when id % 5 < 2 then 7 else id % 50 end as int) as student_id"
        answers = spark.range(0, 60_000, 1, 8).selectExpr("1 as class_id", hot, "0 as slot", "id as answer")
        joined = fusion.join_slots(slots, answers)
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_student_headings_are_shortened(spark, raw):
    names = jobs.load_students(spark, f"{raw}/people").columns
    assert set(schemas.STUDENT_SHORT_NAMES.values()) <= set(names)


def test_participant_survey_equals_the_outer_joins_it_stands_for(spark, raw, rows):
    student, answers, classes = jobs.load_survey_tables(spark, f"{raw}/people", f"{raw}/survey", f"{raw}/people")
    joined = survey.students_with_answers(survey.coded_students(student), survey.scored_answers(answers))
    assert joined.where("student_id = 99 and slot is null and gender_code = 1").count() == 1
    right = survey.in_class(joined, survey.class_hours(classes), "right")
    assert right.where("class_id = 50 and student_id is null").count() == 1
    expected = right.na.drop().select("student_id", "week", "weekday", "slot", "engagement_level", "class_id")
    got = survey.placed_answers(student, answers, classes)
    assert rows(got, *expected.columns) == rows(expected)
    counted = survey.counted_participants(student, answers, classes)
    assert counted.agg(F.sum("copies")).first()[0] == expected.count() > counted.count()
    assert survey.participant_survey(student, answers, classes).columns == PARTICIPANT_SURVEY.names


def test_fused_table(spark, fused):
    df = read_table(spark, fused, FUSED)
    assert spark.read.option("header", True).csv(fused).columns == FUSED.names
    assert df.count() == df.distinct().count() > 0
    assert df.where(" or ".join(f"{m} is null" for m in MEANS)).count() == 0
    assert {r[0] for r in df.select("timestamp").distinct().collect()} == {"09:20:00", "09:40:00"}


def test_stages_one_by_one_give_the_same_table(spark, raw, fused, rows):
    out = [f"{raw}/out/slots.csv", f"{raw}/out/participants.csv", f"{raw}/out/combined"]
    people, answers = f"{raw}/people", f"{raw}/survey"
    jobs.main(["sensors", f"{raw}/wearables", out[0]])
    jobs.main(["participants", people, answers, people, out[1]])
    jobs.main(["combine", *out])
    slots = spark.read.option("header", True).csv(out[0])
    assert slots.columns == schemas.SENSOR_SLOTS.names

    def close(path):
        df = read_table(spark, path, FUSED)
        return rows(df.withColumns({m: F.round(m, 9) for m in MEANS}))

    assert close(out[2]) == close(fused)


def test_imputation_counts_repeated_rows_and_comes_before_dropping_them(spark, rows):
    slots = spark.createDataFrame(
        [(1, 1, 0, 1.0, 1.0, 1.0, 2.0, 1.0), (1, 2, 0, 1.0, 1.0, 1.0, 6.0, 1.0), (1, 3, 0, 1.0, 1.0, 1.0, None, 1.0)],
        "class_id int, participant_id int, slot int, " + ", ".join(f"{m} double" for m in MEANS),
    )
    people = spark.createDataFrame(
        [(1, 0, 12, 0, "Engaged", "R", 1)] * 3 + [(2, 0, 12, 0, "Engaged", "R", 1), (3, 1, 13, 0, "Engaged", "R", 1)],
        "student_id int, gender_code int, age int, slot int, engagement_level string, room string, class_id int",
    )
    df = fusion.fuse(slots, people)
    assert rows(df, "student_id", "timestamp", "ibi_mean") == [
        (1, "00:00:00", 2.0), (2, "00:00:00", 6.0), (3, "00:00:00", 3.0)
    ]
    counted = people.groupBy(*people.columns).agg(F.count("*").alias("copies"))
    assert rows(fusion.fuse(slots, counted)) == rows(df)
    text = fusion.fuse_tables(
        slots.withColumn("slot", F.lit("00:00:00")).withColumnRenamed("slot", "time_format"),
        people.withColumn("slot", F.lit("00:00:00")).withColumnRenamed("slot", "time"),
    )
    assert rows(text) == rows(df)


def test_prepare_and_train(spark, raw, fused):
    train, test = f"{raw}/out/train.csv", f"{raw}/out/test"
    jobs.prepare(spark, fused, train, test)
    whole = read_table(spark, fused, FUSED)
    parts = [read_table(spark, p, FUSED) for p in (train, test)]
    assert sum(p.count() for p in parts) == whole.count()
    assert parts[0].join(parts[1], ["class_id", "student_id", "timestamp"]).count() == 0
    metrics = jobs.train(spark, train, test, f"{raw}/out", f"{raw}/out", iterations=3, learning_rate=0.1, depth=2)
    lines = {r["row"]: r for r in metrics.collect()}
    assert lines["accuracy"]["support"] == parts[1].count()
    model = BoostedTrees.load(spark, f"{raw}/out/model")
    scored = training.predict(model, parts[1])
    hits = scored.where(F.col("prediction_label") == F.col("engagement_level")).count()
    assert lines["accuracy"]["f1_score"] == pytest.approx(hits / parts[1].count())


def test_explore_writes_statistics_of_the_raw_tables(spark, raw):
    people, out = f"{raw}/people", f"{raw}/out/explore"
    jobs.explore(spark, people, f"{raw}/survey", people, out)

    def rows(name):
        return {tuple(r) for r in spark.read.parquet(f"{out}/{name}").collect()}

    assert rows("students_by_gender") == {("female", 6), ("male", 6)}
    assert rows("students_by_age") == {(12, 4), (13, 4), (14, 4)}
    assert rows("survey_participants") == {(12,)}
    assert rows("clothing") == {("shirt", 72), ("scarf", 72)}
    assert {("Weekday", "0", 3), ("Weekday", "1", 2), ("Room", "R9", 1), ("Start_hour", "9", 5)} <= rows("class_frequencies")
    assert rows("class_minutes") == {("long", 52.0, 60.0, 40.0)}
    assert sum(n for _, n in rows("scores")) == 72


def test_prepare_fills_gaps_with_means_of_the_train_part(spark, tmp_path):
    cells = [(i, "r", i, 0, 12, "09:00:00", None if i % 5 == 0 else float(i), 1.0, 1.0, 1.0, 1.0, "Engaged") for i in range(60)]
    fused, train, test = (f"{tmp_path}/{n}" for n in ("fused", "train", "test"))
    spark.createDataFrame(cells, FUSED).write.parquet(fused)
    jobs.prepare(spark, fused, train, test, impute_on_train=True)
    seen = [r["hr_mean"] for r in spark.read.parquet(train).where(F.col("student_id") % 5 != 0).collect()]
    for part in (train, test):
        filled = spark.read.parquet(part).where(F.col("student_id") % 5 == 0).collect()
        assert filled
        assert all(r["hr_mean"] == pytest.approx(sum(seen) / len(seen)) for r in filled)


def test_scaling_step_is_the_population_form(spark):
    df = spark.createDataFrame([(1.0, 7.0, None), (3.0, 7.0, None), (None, 7.0, None)], "x double, flat double, none double")
    scaled = training.scaling_step(df, df.columns).transform(df).select("x_scaled", "flat_scaled", "none_scaled")
    assert [tuple(r) for r in scaled.collect()] == [(-1.0, 0.0, 0.0), (1.0, 0.0, 0.0), (-2.0, 0.0, 0.0)]


def test_training_takes_few_distinct_rows_and_missing_labels(spark):
    from pyspark.sql import functions as F

    from slotfuse.plans.training import predict, train_classifier

    label = F.when(F.col("id") % 50 == 0, None).when(F.col("a") > 1, "Engaged").otherwise("Not Engaged")
    df = spark.range(600).select("id", (F.col("id") % 4).alias("a")).withColumn("engagement_level", label)
    model = train_classifier(df, ["a"], iterations=3, learning_rate=0.3)
    wrong = predict(model, df.dropna()).where("prediction_label != engagement_level")
    assert wrong.count() == 0

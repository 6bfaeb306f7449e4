"""Questionnaire scoring, the joins, and the fused table."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotfuse.catalog import standins
from slotfuse.catalog.registry import query, rounded
from slotfuse.catalog.standins import with_views
from slotfuse.functions import answers
from slotfuse.functions.timeslots import clock_text, with_clock_text
from slotfuse.operators import profile
from slotfuse.operators.conform import drop_incomplete
from slotfuse.operators.joins import dyadic_interval_join
from slotfuse.operators.prepare import impute_mean
from slotfuse.plans import fusion, jobs, survey
from slotfuse.schemas import CLASS_TABLE, ENGAGE, FUSED, MEANS, PARTICIPANT_SURVEY, SENSOR_SLOTS, STUDENT, STUDENT_SURVEY
from slotfuse.sources.staging import fresh_path, stage_table
from slotfuse.sources.tables import read_table, write_table

_SQL_MEANS = ", ".join(f"round({m},6) as {m}" for m in MEANS)


def _tables(spark, sf_dir):
    return (
        standins.students(spark, sf_dir),
        standins.surveys(spark, sf_dir),
        standins.timetable(spark, sf_dir),
    )


def _scores(name):
    return (
        f"cast(case {name} when 'Strongly agree' then 2 when 'Somewhat agree' then 1 "
        f"when 'Somewhat disagree' then -1 when 'Strongly disagree' then -2 else 0 end as int) as {name}"
    )


@query(with_views(f"select Pid, Time, {', '.join(_scores(e) for e in ENGAGE)} from lk_survey", "lk_survey"))
def likert_score(spark, sf_dir):
    """Each answer's score."""
    return standins.surveys(spark, sf_dir).select(
        "Pid", "Time", *[answers.likert_score(e).alias(e) for e in ENGAGE]
    )


@query(with_views("select Pid, Time, score as total, round(score/5, 6) as average from lk_scored", "lk_scored"))
def likert_total(spark, sf_dir):
    """Sum and average of five scores."""
    return standins.surveys(spark, sf_dir).select(
        "Pid",
        "Time",
        answers.likert_total(ENGAGE).alias("total"),
        F.round(answers.likert_average(ENGAGE), 6).alias("average"),
    )


@query(with_views("select Pid, Time, engagement_level from lk_scored", "lk_scored"))
def engagement_level(spark, sf_dir):
    """Two levels, a total of zero being engaged."""
    level = answers.engagement_level(answers.likert_total(ENGAGE))
    return standins.surveys(spark, sf_dir).select("Pid", "Time", level.alias("engagement_level"))


@query(
    with_views(
        f"select Pid, Time, {', '.join(f'''coalesce({e},'Missing') as {e}''' for e in ENGAGE)} from lk_survey",
        "lk_survey",
    )
)
def fill_missing(spark, sf_dir):
    """No answer becomes the text Missing."""
    return standins.surveys(spark, sf_dir).select(
        "Pid", "Time", *[answers.fill_missing(e).alias(e) for e in ENGAGE]
    )


@query(
    with_views(
        "select Pid, cast(case when Gender='female' then 0 else 1 end as int) as gender_code from lk_student",
        "lk_student",
    )
)
def binary_encode(spark, sf_dir):
    """P5: female 0, everything else 1."""
    return standins.students(spark, sf_dir).select(
        "Pid", answers.binary_code("Gender", zero="female").alias("gender_code")
    )


@query(
    with_views(
        "select Pid, "
        + ", ".join(
            f"count(*) filter (where coalesce({e},'Missing')='Strongly agree') as \"{e} Strongly agree\""
            for e in ENGAGE
        )
        + " from lk_survey group by Pid",
        "lk_survey",
    )
)
def agree_counts(spark, sf_dir):
    """How often a student agreed strongly, per question."""
    return profile.answer_counts(standins.surveys(spark, sf_dir), "Pid", ENGAGE, "Strongly agree")


@query(
    with_views(
        "select hour(Time)::int as Hour, round(avg(score),6) as mean from lk_scored group by 1 order by 1",
        "lk_scored",
    )
)
def hourly_mean(spark, sf_dir):
    """Mean engagement score per hour of the day."""
    scored = standins.surveys(spark, sf_dir).select(
        F.hour("Time").alias("Hour"), answers.likert_total(ENGAGE).alias("score")
    )
    return rounded(profile.mean_by(scored, "Hour", "score", "mean").orderBy("Hour"), ["mean"])


@query(
    with_views(
        """select hour(Time)::int as Hour, round(avg(score),6) as mean,
        round(avg(score) - 1.96*stddev_samp(score)/sqrt(count(score)),6) as lower,
        round(avg(score) + 1.96*stddev_samp(score)/sqrt(count(score)),6) as upper
        from lk_scored group by 1""",
        "lk_scored",
    )
)
def hourly_mean_band(spark, sf_dir):
    """The same with a 95 % band."""
    scored = standins.surveys(spark, sf_dir).select(
        F.hour("Time").alias("Hour"), answers.likert_total(ENGAGE).alias("score")
    )
    return rounded(profile.mean_band(scored, "Hour", "score"), ["mean", "lower", "upper"])


@query(
    with_views(
        "select "
        + ", ".join(
            f"cast(sum(({c} is null)::int) as bigint) as {c}" for c in ["Pid", "Week", "Weekday", "Time", *ENGAGE]
        )
        + " from lk_survey",
        "lk_survey",
    )
)
def null_profile_sum(spark, sf_dir):
    """A2: NULLs per column as sums."""
    return profile.null_sums(standins.surveys(spark, sf_dir))


@query(
    with_views(
        "select "
        + ", ".join(
            f"count(*) filter (where {c} is null) as {c}" for c in ["Pid", "Week", "Weekday", "Time", *ENGAGE]
        )
        + " from lk_survey",
        "lk_survey",
    )
)
def null_profile_count(spark, sf_dir):
    """A3: NULLs per column as counts."""
    return profile.null_counts(standins.surveys(spark, sf_dir))


@query(
    with_views(
        "select * exclude (slot) from lk_survey where "
        + " and ".join(f"{e} is not null" for e in ENGAGE)
        + " and Pid is not null and Time is not null",
        "lk_survey",
    )
)
def drop_null_rows(spark, sf_dir):
    """P10: rows with an answer to every question."""
    return drop_incomplete(standins.surveys(spark, sf_dir))


@query(
    with_views(
        "select Engage_1, count(*) as count from lk_survey where Engage_1 is not null group by 1", "lk_survey"
    )
)
def value_counts(spark, sf_dir):
    """A5: answers to one question, no answer left out."""
    return profile.value_counts(standins.surveys(spark, sf_dir), "Engage_1")


@query(
    with_views(
        "select Gender, count(distinct Pid) as TotalPid from lk_student where Gender is not null group by 1",
        "lk_student",
    )
)
def group_nunique(spark, sf_dir):
    """Students per gender, unknown gender left out."""
    return profile.distinct_per_group(standins.students(spark, sf_dir), "Gender", "Pid", "TotalPid")


@query(
    with_views(
        """select t.Pid as student_id, cast(case when Gender='female' then 0 else 1 end as int) as gender_code,
        Age as age, v.Week as week, v.Weekday as weekday, slot as time, engagement_level
        from lk_student t left join lk_scored v on t.Pid=v.Pid""",
        "lk_student",
        "lk_scored",
    )
)
def join_left_student_survey(spark, sf_dir):
    """Every student with their answers."""
    rows = survey.students_with_answers(
        survey.coded_students(standins.students(spark, sf_dir)),
        survey.scored_answers(standins.surveys(spark, sf_dir)),
    )
    return rows.withColumn("time", clock_text(F.col("slot"))).drop("slot")


@query(
    with_views(
        """select v.Pid as student_id, v.Week as week, v.Weekday as weekday, slot as time,
        engagement_level, Room as room, Class_id as class_id
        from lk_scored v right join lk_class c
        on v.Week=c.Week and v.Weekday=c.Weekday and slot between c.s and c.e""",
        "lk_scored",
        "lk_class",
    )
)
def join_interval_right(spark, sf_dir):
    """Every class with the answers given in it."""
    rows = survey.in_class(
        survey.scored_answers(standins.surveys(spark, sf_dir)), standins.classes(spark, sf_dir), "right"
    )
    rows = rows.withColumn("time", clock_text(F.col("slot")))
    return rows.select("student_id", "week", "weekday", "time", "engagement_level", "room", "class_id")


@query(
    with_views(
        """select v.Pid as student_id, v.Week as week, v.Weekday as weekday, slot as time,
        engagement_level, Room as room, Class_id as class_id
        from lk_scored v right join lk_class c
        on v.Week=c.Week and v.Weekday=c.Weekday and slot between c.s and c.e""",
        "lk_scored",
        "lk_class",
    )
)
def join_interval_dyadic(spark, sf_dir):
    """The same rows by dyadic nodes, whose number does not grow with a class's length."""
    rows = dyadic_interval_join(
        survey.scored_answers(standins.surveys(spark, sf_dir)), standins.classes(spark, sf_dir),
        [("week", "class_week"), ("weekday", "class_weekday")], "slot", "start_second", "finish_second", "right", finest=300,
    )
    rows = rows.withColumn("time", clock_text(F.col("slot")))
    return rows.select("student_id", "week", "weekday", "time", "engagement_level", "room", "class_id")


@query(with_views(f"select {', '.join(PARTICIPANT_SURVEY.names)} from lk_participants", "lk_participants"))
def join_interval_inner(spark, sf_dir):
    """The participant survey, nothing missing."""
    return survey.participant_survey(*_tables(spark, sf_dir))


@query(
    with_views(
        f"""select class_id, room, student_id, gender_code, age, time_format, {_SQL_MEANS}, engagement_level
        from lk_joined""",
        "lk_joined",
    )
)
def join_fusion(spark, sf_dir):
    """Sensor slots with what was answered in them, a row per answer."""
    answered = survey.placed_answers(*_tables(spark, sf_dir))
    # Staged, so that the join's own shuffle can be split where one slot has very many answers.
    rows = fusion.join_slots(stage_table(standins.device_slots(spark, sf_dir), "slots"), answered)
    return rounded(
        with_clock_text(rows, "slot", "time_format").select(
            "class_id", "room", "student_id", "gender_code", "age", "time_format", *MEANS, "engagement_level"
        ),
        MEANS,
    )


@query(
    with_views(
        """select class_id, participant_id, time_format,
        round(coalesce(eda_mean, (select avg(eda_mean) from lk_device)),6) as eda_mean,
        round(coalesce(ibi_mean, (select avg(ibi_mean) from lk_device)),6) as ibi_mean from lk_device""",
        "lk_device",
    ),
    name="impute_mean",
)
def impute_means(spark, sf_dir):
    """M1: missing means replaced by the table's mean."""
    slots = with_clock_text(standins.device_slots(spark, sf_dir), "slot", "time_format")
    columns = list(fusion.IMPUTED)
    filled = impute_mean(slots, columns)
    return rounded(filled.select("class_id", "participant_id", "time_format", *columns), columns)


@query(
    with_views("select distinct * from lk_participants", "lk_participants")
)
def distinct_rows(spark, sf_dir):
    """Whole rows without repetition."""
    rows = survey.participant_survey(*_tables(spark, sf_dir))
    return rows.distinct()


@query(
    with_views(
        f"""select distinct class_id, room, student_id, gender_code, age, time_format as timestamp,
        round(hr_mean,6) as hr_mean, round(temp_mean,6) as temp_mean,
        round(coalesce(eda_mean, (select avg(eda_mean) from lk_joined)),6) as eda_mean,
        round(coalesce(ibi_mean, (select avg(ibi_mean) from lk_joined)),6) as ibi_mean,
        round(bvp_mean,6) as bvp_mean, engagement_level from lk_joined""",
        "lk_joined",
    )
)
def flagship_fusion(spark, sf_dir):
    """Sensors and questionnaires fused, imputed and deduplicated."""
    participants = survey.counted_participants(*_tables(spark, sf_dir))
    fused = fusion.fuse(standins.device_slots(spark, sf_dir), participants)
    return rounded(fused, MEANS)


_SQL_FUSED = f"""select distinct class_id, room, student_id, gender_code, age, time_format as timestamp,
    hr_mean, temp_mean, coalesce(eda_mean, (select avg(eda_mean) from lk_joined)) as eda_mean,
    coalesce(ibi_mean, (select avg(ibi_mean) from lk_joined)) as ibi_mean, bvp_mean, engagement_level from lk_joined"""


@query(
    with_views(
        f"""select class_id, room, student_id, gender_code, age, timestamp, {_SQL_MEANS}, engagement_level,
        case when cast('0x' || substr(md5(class_id || '|' || student_id || '|' || timestamp),1,8) as bigint) % 100 < 80
            then 'train' else 'test' end as part from ({_SQL_FUSED})""",
        "lk_joined",
    )
)
def stages_on_paths(spark, sf_dir):
    """Input files written, then the stages from path to path: participants, combine, prepare."""
    folder = fresh_path(spark, "stages")
    for name, rows, schema in (
        ("student", standins.students(spark, sf_dir), STUDENT),
        ("student_survey", standins.surveys(spark, sf_dir), STUDENT_SURVEY),
        ("class_table", standins.timetable(spark, sf_dir), CLASS_TABLE),
    ):
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in rows.columns}
        write_table(rows.withColumns(missing), f"{folder}/in/{name}.csv")
    slots = standins.device_slots(spark, sf_dir).withColumn("time_format", clock_text(F.col("slot")))
    write_table(slots.select(*SENSOR_SLOTS.names), f"{folder}/slots.csv")
    jobs.participants(spark, f"{folder}/in", f"{folder}/in", f"{folder}/in", f"{folder}/participants.csv")
    jobs.combine(spark, f"{folder}/slots.csv", f"{folder}/participants.csv", f"{folder}/fused.csv")
    jobs.prepare(spark, f"{folder}/fused.csv", f"{folder}/train.csv", f"{folder}/test")
    train, test = (
        read_table(spark, f"{folder}/{path}", FUSED).withColumn("part", F.lit(part)) for part, path in (("train", "train.csv"), ("test", "test"))
    )
    return rounded(train.unionByName(test), MEANS)


@query(
    with_views(
        " union all ".join(
            f"""select '{m}' as "column", count({m}) as count, round(avg({m}),6) as mean,
            round(stddev_samp({m}),6) as stddev, round(min({m}),6) as min, round(max({m}),6) as max from lk_device"""
            for m in MEANS
        ),
        "lk_device",
    )
)
def describe_stats(spark, sf_dir):
    """Five numbers per sensor mean."""
    stats = profile.describe(standins.device_slots(spark, sf_dir), MEANS)
    return rounded(stats, ["mean", "stddev", "min", "max"])


@query(
    with_views(
        " union all ".join(
            f"""select '{a}' as "column", """
            + ", ".join(
                f"1.0::double as {b}" if a == b else f"round(corr({a},{b}),6) as {b}" for b in MEANS
            )
            + " from lk_device"
            for a in MEANS
        ),
        "lk_device",
    )
)
def corr_sensors(spark, sf_dir):
    """Correlations of the sensor means, each over the slots that have both."""
    return rounded(profile.correlation_matrix(standins.device_slots(spark, sf_dir), MEANS), MEANS)

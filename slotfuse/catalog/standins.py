"""The test tables seen as students, timetable, questionnaires and sensors.

`events` has exactly five types, which stand for the five channels, and is the only
table with times of day; each event is both a reading and a questionnaire. All views
cover their whole tables. `CTES` holds the same views for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse import schemas
from slotfuse.catalog.registry import table
from slotfuse.functions.answers import LIKERT_SCORES
from slotfuse.functions.timeslots import second_of_day, slot_of_day
from slotfuse.operators.joins import interval_join
from slotfuse.operators.sensors import wide_slot_means

EVENT_CHANNELS = {
    "click": "hr_mean",
    "view": "temp_mean",
    "purchase": "eda_mean",
    "signup": "ibi_mean",
    "error": "bvp_mean",
}
ANSWERS = list(LIKERT_SCORES)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("user_id").cast("int").alias("participant_id"),
        "event_type",
        "value",
        F.weekofyear(ts).alias("wk"),
        F.weekday(ts).alias("wd"),
        second_of_day(ts).alias("second"),
        slot_of_day(ts).alias("slot"),
    )


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    gender = F.when(segment == "HOUSEHOLD", "female").when(segment != "MACHINERY", "male")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("Pid"),
        gender.alias("Gender"),
        (12 + F.col("c_custkey") % 6).cast("int").alias("Age"),
    )


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A questionnaire per event; the answers are the base-6 digits of its value."""
    cents = F.round(F.col("value") * 100).cast("long")
    answers = F.array(*[F.lit(a) for a in ANSWERS])

    def answer(i: int):
        digit = F.floor(cents / 6**i) % 6
        return F.when(digit < len(ANSWERS), F.element_at(answers, (digit + 1).cast("int")))

    return readings(spark, sf_dir).select(
        F.col("participant_id").alias("Pid"),
        F.col("wk").alias("Week"),
        F.col("wd").alias("Weekday"),
        F.col("ts").alias("Time"),
        *[answer(i).alias(name) for i, name in enumerate(schemas.ENGAGE)],
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven classes per nation, four and a half hours each, overlapping by half an hour."""
    key = F.col("n_nationkey")
    start = F.floor(key / 5) * 4 * 3600
    return table(spark, sf_dir, "nation").select(
        F.explode(F.sequence(F.lit(0), F.lit(6))).alias("class_weekday"),
        (key * 7 + F.col("class_weekday")).cast("int").alias("class_id"),
        F.col("n_name").alias("room"),
        (1 + key % 5).cast("int").alias("class_week"),
        start.cast("int").alias("start_second"),
        (start + 4 * 3600 + 1800).cast("int").alias("finish_second"),
    )


def timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`classes` in the layout of a class table, hours as timestamps of one day."""
    day = F.lit("2024-01-01").cast("timestamp_ntz")

    def at(seconds: str):
        return day + F.make_dt_interval(secs=F.col(seconds))

    return classes(spark, sf_dir).select(
        F.col("class_id").alias("Class_id"),
        F.col("room").alias("Room"),
        at("start_second").alias("Start_time"),
        at("finish_second").alias("Finish_time"),
        F.col("class_week").alias("Week"),
        F.col("class_weekday").alias("Weekday"),
    )


def device_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor slots: readings in the classes they fall in, all channels in one pass."""
    placed = interval_join(
        readings(spark, sf_dir),
        classes(spark, sf_dir),
        [("wk", "class_week"), ("wd", "class_weekday")],
        "second",
        "start_second",
        "finish_second",
    )
    return wide_slot_means(
        placed,
        ["class_id", "participant_id", "slot"],
        EVENT_CHANNELS,
        channel="event_type",
        keep_stray=False,
    )


def _sql_answers() -> str:
    cases = " ".join(f"when {i} then '{a}'" for i, a in enumerate(ANSWERS))
    return ", ".join(
        f"case cast(floor(cents/{6**i}) as bigint)%6 {cases} end as {name}"
        for i, name in enumerate(schemas.ENGAGE)
    )


SQL_CLOCK = (
    "printf('%02d:%02d:%02d', cast({0}//3600 as int), cast({0}%3600//60 as int), cast({0}%60 as int))"
)
SQL_CHANNEL_MEANS = ", ".join(
    f"avg(case when event_type='{code}' then value end) as {name}"
    for code, name in EVENT_CHANNELS.items()
)
_SQL_SCORE = "(" + " + ".join(
    f"(case {e} when 'Strongly agree' then 2 when 'Somewhat agree' then 1 "
    f"when 'Somewhat disagree' then -1 when 'Strongly disagree' then -2 else 0 end)"
    for e in schemas.ENGAGE
) + ")"

_VIEWS = {
    "ev": """select *, cast(weekofyear(ts) as int) as wk, cast(isodow(ts)-1 as int) as wd,
        strftime(ts,'%H:%M:%S') as tod,
        cast(hour(ts)*3600+minute(ts)*60+second(ts) as int) as sec,
        cast(sec - sec%300 as int) as sl, cast(round(value*100) as bigint) as cents from events""",
    "lk_student": """select cast(c_custkey as int) as Pid,
        case c_mktsegment when 'HOUSEHOLD' then 'female' when 'MACHINERY' then null else 'male' end as Gender,
        cast(12+c_custkey%6 as int) as Age from customer""",
    "lk_class": """select cast(n_nationkey*7+d as int) as Class_id, n_name as Room,
        cast(1+n_nationkey%5 as int) as Week, d as Weekday,
        printf('%02d:00:00', cast(floor(n_nationkey/5) as int)*4) as s,
        printf('%02d:30:00', cast(floor(n_nationkey/5) as int)*4+4) as e
        from nation cross join (select cast(range as int) as d from range(7))""",
    "lk_survey": f"""select cast(user_id as int) as Pid, wk as Week, wd as Weekday, ts as Time,
        {SQL_CLOCK.format('sl')} as slot, {_sql_answers()} from ev""",
    "lk_scored": f"""select *, cast({_SQL_SCORE} as int) as score,
        case when {_SQL_SCORE} >= 0 then 'Engaged' else 'Not Engaged' end as engagement_level
        from lk_survey""",
    "lk_device": f"""select Class_id as class_id, cast(user_id as int) as participant_id,
        {SQL_CLOCK.format('sl')} as time_format, {SQL_CHANNEL_MEANS}
        from ev join lk_class c on wk=c.Week and wd=c.Weekday and tod between c.s and c.e
        group by 1,2,3""",
    "lk_participants": """select v.Pid as student_id,
        cast(case when Gender='female' then 0 else 1 end as int) as gender_code, Age as age,
        v.Week as week, v.Weekday as weekday, slot as time, engagement_level,
        Room as room, Class_id as class_id
        from lk_student t join lk_scored v on t.Pid=v.Pid
        join lk_class c on v.Week=c.Week and v.Weekday=c.Weekday and slot between c.s and c.e""",
    "lk_joined": """select d.*, p.* exclude (class_id) from lk_device d join lk_participants p
        on d.class_id=p.class_id and d.participant_id=p.student_id and d.time_format=p.time""",
}
_USES = {
    "lk_survey": ["ev"],
    "lk_scored": ["lk_survey"],
    "lk_device": ["ev", "lk_class"],
    "lk_participants": ["lk_student", "lk_scored", "lk_class"],
    "lk_joined": ["lk_device", "lk_participants"],
}


def with_views(sql: str, *names: str) -> str:
    """`sql` behind the WITH clause of the views it names, and of those they use."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for used in _USES.get(name, []):
            need(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    return "with " + ",\n".join(f"{n} as ({_VIEWS[n]})" for n in ordered) + "\n" + sql

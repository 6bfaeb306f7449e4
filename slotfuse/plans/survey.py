"""Students, questionnaire and timetable -> one row per answered questionnaire and class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotfuse.functions.answers import binary_code, engagement_level, likert_total
from slotfuse.functions.timeslots import second_of_day, slot_of_day, with_clock_text
from slotfuse.operators.joins import interval_join, keep_left_join
from slotfuse.schemas import ENGAGE, PARTICIPANT_SURVEY


def coded_students(student: DataFrame) -> DataFrame:
    return student.select(
        F.col("Pid").alias("student_id"),
        binary_code("Gender", zero="female").alias("gender_code"),
        F.col("Age").alias("age"),
    )


def scored_answers(survey: DataFrame) -> DataFrame:
    """student_id, week, weekday, slot (seconds) and engagement_level per answer."""
    return survey.select(
        F.col("Pid").alias("student_id"),
        F.col("Week").alias("week"),
        F.col("Weekday").alias("weekday"),
        slot_of_day(F.col("Time")).alias("slot"),
        engagement_level(likert_total(ENGAGE)).alias("engagement_level"),
    )


def counted_answers(answers: DataFrame) -> DataFrame:
    """Equal answers as one row with their number in `copies`.

    Counting before any join keeps the joins even: a student has at most two rows per
    slot, however many answers there are.
    """
    return answers.groupBy(*answers.columns).agg(F.count("*").alias("copies"))


def class_hours(classes: DataFrame) -> DataFrame:
    """class_id, room, class_week, class_weekday and the hours in seconds."""
    return classes.select(
        F.col("Class_id").alias("class_id"),
        F.col("Room").alias("room"),
        F.col("Week").alias("class_week"),
        F.col("Weekday").alias("class_weekday"),
        second_of_day(F.col("Start_time")).alias("start_second"),
        second_of_day(F.col("Finish_time")).alias("finish_second"),
    )


def students_with_answers(students: DataFrame, answers: DataFrame) -> DataFrame:
    """Every student, with their answers if any."""
    return keep_left_join(students, answers, ["student_id"])


def in_class(answers: DataFrame, hours: DataFrame, how: str = "inner") -> DataFrame:
    """Answers with each class that was on; how='right' keeps classes without answers."""
    return interval_join(
        answers,
        hours,
        [("week", "class_week"), ("weekday", "class_weekday")],
        "slot",
        "start_second",
        "finish_second",
        how,
    )


def _complete(students: DataFrame, answers: DataFrame, hours: DataFrame) -> DataFrame:
    # Rows with a NULL are dropped in the end, which leaves nothing of the outer parts.
    known = students.join(answers, "student_id", "inner")
    return in_class(known, hours).where(
        F.col("age").isNotNull() & F.col("room").isNotNull() & F.col("class_id").isNotNull()
    )


def placed_answers(student: DataFrame, survey: DataFrame, classes: DataFrame) -> DataFrame:
    """A row per answer and class it was given in, time as `slot` seconds, nothing missing."""
    return _complete(coded_students(student), scored_answers(survey), class_hours(classes))


def participant_survey(student: DataFrame, survey: DataFrame, classes: DataFrame) -> DataFrame:
    """`placed_answers` as the participant survey table."""
    rows = placed_answers(student, survey, classes)
    return with_clock_text(rows, "slot", "time").select(*PARTICIPANT_SURVEY.names)


def counted_participants(student: DataFrame, survey: DataFrame, classes: DataFrame) -> DataFrame:
    """`placed_answers` with equal rows counted in `copies` instead of repeated."""
    answers = counted_answers(scored_answers(survey))
    return _complete(coded_students(student), answers, class_hours(classes))

"""Statistics of the raw student, timetable and questionnaire tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.functions.answers import fill_missing, likert_total, list_items
from slotfuse.functions.timeslots import minutes_between
from slotfuse.operators import profile
from slotfuse.schemas import DISTRACTED, ENGAGE, GENERAL_FEELING, STUDENT_SHORT_NAMES

Reports = dict[str, DataFrame]


def frequencies(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """column, value, count of several columns in one scan; NULL is a value."""
    cells = [F.struct(F.lit(n).alias("column"), c.cast("string").alias("value")) for n, c in columns.items()]
    return profile.group_count(df.select(F.inline(F.array(*cells))), "column", "value")


def _plain(names: Sequence[str]) -> dict[str, Column]:
    return {name: F.col(f"`{name}`") for name in names}


def student_reports(student: DataFrame) -> Reports:
    feeling, distracted = STUDENT_SHORT_NAMES[GENERAL_FEELING], STUDENT_SHORT_NAMES[DISTRACTED]
    return {
        "student_nulls": profile.null_counts(student),
        "student_frequencies": frequencies(student, _plain([feeling])),
        "students_by_gender": profile.distinct_per_group(student, "Gender", "Pid", "students"),
        "students_by_age": profile.distinct_per_group(student, "Age", "Pid", "students"),
        "distracted_by_gender": profile.group_count(
            student, F.col("Gender").alias("gender"), F.col(f"`{distracted}`").alias("distracted")
        ),
    }


def timetable_reports(timetable: DataFrame) -> Reports:
    hours = {"Start_hour": F.hour("Start_time"), "Finish_hour": F.hour("Finish_time")}
    minutes = minutes_between(F.col("Start_time"), F.col("Finish_time"))
    names = {"avg": "average", "max": "maximum", "min": "minimum"}
    return {
        "class_nulls": profile.null_counts(timetable),
        "class_frequencies": frequencies(
            timetable, {**_plain(["Room", "Subject", "Class_len", "Weekday"]), **hours}
        ),
        "class_minutes": profile.spread_stats(timetable, "Class_len", minutes, names),
    }


def questionnaire_reports(answers: DataFrame) -> Reports:
    filled = answers.withColumns({name: fill_missing(name) for name in ENGAGE})
    scored = answers.select(F.hour("Time").alias("hour"), likert_total(ENGAGE).alias("score"))
    clothes = answers.select(list_items("Clothing").alias("clothing"))
    return {
        "survey_nulls": profile.null_counts(answers),
        "survey_participants": profile.distinct_count(answers, "Pid", "participants"),
        "survey_frequencies": frequencies(answers, _plain(["Weekday", "Thermal_sensation"])),
        "thermal_preferences": profile.group_count(answers, "Thermal_sensation", "Thermal_preference"),
        "clothing": profile.group_count(clothes, "clothing"),
        "places": profile.group_count(answers, "Loc_x", "Loc_y", "Thermal_sensation"),
        "strongly_agree": profile.answer_counts(filled, "Pid", ENGAGE, "Strongly agree"),
        "scores": profile.group_count(scored, "score"),
        "score_by_hour": profile.mean_by(scored, "hour", "score", "mean"),
    }

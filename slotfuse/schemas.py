"""Declared schemas of the input tables and of the tables handed between stages."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_INT, _TEXT, _TIME, _DOUBLE = T.IntegerType(), T.StringType(), T.TimestampType(), T.DoubleType()

# Questionnaire headings as they stand in the student file, and the
# short names they get.
GENERAL_FEELING = "What is your general feeling in the classroom? - 1"
NOT_TOO_HOT = "When I am engaged in class: - I usually don't feel too hot or too cold."
DISTRACTED = (
    "When I am engaged in class: - I could get distracted when the room is too hot or too cold."
)
STUDENT_SHORT_NAMES = {
    GENERAL_FEELING: "General Feeling in Classroom",
    NOT_TOO_HOT: "I usually don't feel too hot or cold in class (Engaged)",
    DISTRACTED: "Distracted by Temperature (Engaged)",
}

STUDENT = _struct(
    **{
        "Pid": _INT,
        "Gender": _TEXT,
        "Age": _INT,
        "Form Room": _TEXT,
        "Math Room": _TEXT,
        "Language Room": _TEXT,
        GENERAL_FEELING: _INT,
        NOT_TOO_HOT: _TEXT,
        DISTRACTED: _TEXT,
    }
)

CLASS_TABLE = _struct(
    Class_id=_INT,
    Room=_TEXT,
    Start_time=_TIME,
    Finish_time=_TIME,
    Class_len=_TEXT,
    Week=_INT,
    Weekday=_INT,
    Class_no=_INT,
    Subject=_TEXT,
    is_Form=_TEXT,
)

ENGAGE = ["Engage_1", "Engage_2", "Engage_3", "Engage_4", "Engage_5"]

STUDENT_SURVEY = _struct(
    Pid=_INT,
    Week=_INT,
    Weekday=_INT,
    Time=_TIME,
    Thermal_sensation=_INT,
    Thermal_preference=_TEXT,
    Clothing=_TEXT,
    Loc_x=_INT,
    Loc_y=_INT,
    **{name: _TEXT for name in ENGAGE},
    Arousal=_INT,
    Valence=_INT,
    Confidence_level=_INT,
)

# Sensor files have no heading; what a reading belongs to is in the file's path.
READING = _struct(value=T.FloatType(), Time=_TIME)

# channel (file name without ".csv", lower case) -> name of its mean
CHANNELS = {
    "hr": "hr_mean",
    "temp": "temp_mean",
    "eda": "eda_mean",
    "ibi": "ibi_mean",
    "bvp": "bvp_mean",
}
MEANS = list(CHANNELS.values())

SENSOR_SLOTS = _struct(
    class_id=_INT, participant_id=_INT, time_format=_TEXT, **{m: _DOUBLE for m in MEANS}
)

PARTICIPANT_SURVEY = _struct(
    student_id=_INT,
    gender_code=_INT,
    age=_INT,
    week=_INT,
    weekday=_INT,
    time=_TEXT,
    engagement_level=_TEXT,
    room=_TEXT,
    class_id=_INT,
)

FUSED = _struct(
    class_id=_INT,
    room=_TEXT,
    student_id=_INT,
    gender_code=_INT,
    age=_INT,
    timestamp=_TEXT,
    **{m: _DOUBLE for m in MEANS},
    engagement_level=_TEXT,
)
TARGET = "engagement_level"

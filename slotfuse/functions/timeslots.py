"""Time of day as whole seconds, and the five-minute grid.

Everything is computed on integers, so a result never depends on the day the job
runs; the `HH:mm:ss` text is only written at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_SECONDS = 300


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def slot_of_day(ts: Column, width: int = SLOT_SECONDS) -> Column:
    """Start of the half-open slot a time of day falls in, in seconds after midnight.

    Slots of whole minutes that fill an hour look at hour and minute once each: Spark
    evaluates a join key more than once, and taking a timestamp apart is not cheap.
    """
    if 3600 % width == 0 and width % 60 == 0:
        return F.hour(ts) * 3600 + (F.minute(ts) / (width // 60)).cast("int") * width
    second = second_of_day(ts)
    return second - second % width


def clock_text(seconds: Column) -> Column:
    """`HH:mm:ss` of seconds after midnight; NULL stays NULL."""

    def two_digits(part: Column) -> Column:
        return F.lpad(part.cast("int").cast("string"), 2, "0")

    return F.concat(
        two_digits(F.floor(seconds / 3600)),
        F.lit(":"),
        two_digits(F.floor(seconds % 3600 / 60)),
        F.lit(":"),
        two_digits(seconds % 60),
    )


def clock_seconds(text: Column) -> Column:
    """Seconds after midnight of `HH:mm:ss`; NULL where a part is missing or no number."""

    def part(place: int) -> Column:
        return F.split_part(text, F.lit(":"), F.lit(place)).try_cast("int")

    return part(1) * 3600 + part(2) * 60 + part(3)


def with_clock_text(df: DataFrame, slot: str, name: str) -> DataFrame:
    """Replace seconds after midnight by their text, at the same place."""
    return df.select(
        *[clock_text(F.col(c)).alias(name) if c == slot else F.col(c) for c in df.columns]
    )


def with_clock_seconds(df: DataFrame, text: str, name: str) -> DataFrame:
    """Replace clock text by seconds after midnight, at the same place."""
    return df.select(
        *[clock_seconds(F.col(c)).alias(name) if c == text else F.col(c) for c in df.columns]
    )


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def floor_to_slot(ts: Column, minutes: int = SLOT_SECONDS // 60) -> Column:
    """Timestamp rounded down to the grid (`minutes` divides an hour).

    Takes off what the clock shows past the grid line, so both timestamp types keep
    their type and times before 1970 round down like all others.
    """
    surplus = F.make_dt_interval(
        mins=F.minute(ts) % minutes, secs=F.extract(F.lit("SECOND"), ts)
    )
    return ts - surplus


def minutes_between(start: Column, finish: Column) -> Column:
    """Length in minutes to one decimal, on whole seconds; no zone comes into it."""
    return F.round(F.timestamp_diff("SECOND", start, finish) / 60, 1)

"""Scores for questionnaire answers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five answers and what they count.
LIKERT_SCORES = {
    "Strongly agree": 2,
    "Somewhat agree": 1,
    "Neither agree nor disagree": 0,
    "Somewhat disagree": -1,
    "Strongly disagree": -2,
}
ENGAGED, NOT_ENGAGED = "Engaged", "Not Engaged"
MISSING = "Missing"


def likert_score(answer: str | Column) -> Column:
    """Score of one answer; no answer and unknown answers count 0."""
    answer = F.col(answer) if isinstance(answer, str) else answer
    scored = [(text, score) for text, score in LIKERT_SCORES.items() if score]
    return reduce(
        lambda rest, item: F.when(answer == item[0], item[1]).otherwise(rest),
        scored,
        F.lit(0),
    )


def likert_total(answers: Sequence[str | Column]) -> Column:
    return reduce(Column.__add__, [likert_score(a) for a in answers])


def likert_average(answers: Sequence[str | Column]) -> Column:
    return likert_total(answers) / len(answers)


def engagement_level(total: Column) -> Column:
    """A total of zero counts as engaged."""
    return F.when(total >= 0, ENGAGED).otherwise(NOT_ENGAGED)


def fill_missing(answer: str) -> Column:
    return F.coalesce(F.col(answer), F.lit(MISSING))


def binary_code(column: str | Column, zero: str) -> Column:
    """0 for `zero`, 1 for every other value and for NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column == zero, 0).otherwise(1)


def list_items(column: str, separator: str = ",", trim: bool = False) -> Column:
    """One row per item of a separated list; rows without a list vanish."""
    items = F.split(F.col(column), separator)
    if trim:
        items = F.transform(items, lambda item: F.trim(item))
    return F.explode(items)

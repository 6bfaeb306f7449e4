"""Summary tables of one dataset.

Every function reads its input once. Tables with one row per column or bin are one
aggregate whose single row is unfolded afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.operators.conform import clean_number


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def null_sums(df: DataFrame) -> DataFrame:
    """NULLs per column in one row; NULL for a table without rows."""
    return df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column in one row; 0 for a table without rows."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def group_count(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    """Rows per group; NULL is a group."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per value; NULL is not a value."""
    return group_count(df.where(F.col(key).isNotNull()), key, name=name)


def distinct_per_group(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Distinct values per group, the NULL group left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(counted).alias(name))


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column, NULL counting as one of them."""
    some_null = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
    counted = F.countDistinct(column) + F.coalesce(some_null, F.lit(0))
    return df.agg(counted.cast("long").alias(name))


def _pivot_values(df: DataFrame, columns: str, values: Sequence | None, rest: str) -> tuple[DataFrame, list | None]:
    """With a list of values, all others (NULL too) are put under `rest`."""
    if values is None:
        return df, None
    known = F.when(F.col(columns).isin(list(values)), F.col(columns).cast("string")).otherwise(F.lit(rest))
    return df.withColumn(columns, known), [*map(str, values), rest]


def pivot_counts(
    df: DataFrame, rows: str, columns: str, values: Sequence | None = None, rest: str = "other"
) -> DataFrame:
    """Rows per `rows` x `columns`, a column per value; an empty cell is NULL.

    Without `values` a first job finds them, NULL included. With them, rows of any other
    value are counted in the column `rest`, so none is lost.
    """
    df, listed = _pivot_values(df, columns, values, rest)
    return df.groupBy(rows).pivot(columns, listed).agg(F.count(F.lit(1)))


def pivot_grouped(counts: DataFrame, rows: str, columns: str, cell: str) -> DataFrame:
    """Matrix of an already grouped table with one row per cell; a column per value."""
    return counts.groupBy(rows).pivot(columns).agg(F.first(cell))


def spread_stats(df: DataFrame, key: str, value: str | Column, names: dict[str, str]) -> DataFrame:
    """avg, max and min of `value` per group, under the given names."""
    column = F.col(value) if isinstance(value, str) else value
    stats = {"avg": F.avg, "max": F.max, "min": F.min}
    return df.groupBy(key).agg(*[stats[s](column).alias(name) for s, name in names.items()])


def answer_counts(df: DataFrame, key: str, questions: Sequence[str], answer: str) -> DataFrame:
    """How often each question got `answer`, per key."""
    return df.groupBy(key).agg(
        *[F.count_if(F.col(q) == answer).alias(f"{q} {answer}") for q in questions]
    )


def mean_by(df: DataFrame, key: str | Column, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def mean_band(df: DataFrame, key: str | Column, value: str) -> DataFrame:
    """Mean per group with a 95 % band of mean +- 1.96 s / sqrt(n).

    A group of one has a mean and no band.
    """
    half = 1.96 * F.stddev_samp(value) / F.sqrt(F.count(value))
    mean = F.avg(value)
    return df.groupBy(key).agg(
        mean.alias("mean"), (mean - half).alias("lower"), (mean + half).alias("upper")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max, one row per column."""
    summaries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*summaries).alias("_rows")).select(F.inline("_rows"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson coefficient over rows with both values; NULL where one is constant."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Square matrix as rows: `column` and a coefficient for every column."""
    number = {c: clean_number(c) for c in columns}
    pairs = [correlation(number[a], number[b]).alias(f"{a}~{b}") for a, b in combinations(columns, 2)]
    spread = [F.stddev_pop(number[c]).alias(f"{c}~{c}") for c in columns]
    row = df.agg(*pairs, *spread)

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.when(F.col(f"`{a}~{a}`") > 0, F.lit(1.0))
        first, second = sorted((a, b), key=list(columns).index)
        return F.col(f"`{first}~{second}`")

    lines = [
        F.struct(F.lit(a).alias("column"), *[cell(a, b).alias(b) for b in columns])
        for a in columns
    ]
    return row.select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, column: str, bins: int = 12) -> DataFrame:
    """Counts in equal-width bins from the least to the greatest value.

    The last bin is closed above; values all alike get a range one wide around them.
    """
    number = clean_number(column)
    ends = df.agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).cast("double").alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).cast("double").alias("hi"),
        ).alias("ends")
    ).scalar()
    lo, hi = ends["lo"], ends["hi"]
    place = F.least(F.floor((number - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    # One row of partial counts per task is all that moves. (`least` skips NULL.)
    counted = df.where(number.isNotNull()).select(place.alias("_bin")).agg(
        F.array(*[F.count_if(F.col("_bin") == b) for b in range(bins)]).alias("_counts")
    )
    width = (hi - lo) / bins
    return counted.select(F.posexplode("_counts").alias("bin", "count")).select(
        "bin",
        (lo + F.col("bin") * width).alias("from"),
        (lo + (F.col("bin") + 1) * width).alias("to"),
        "count",
    )


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First `n` rows in the given order."""
    return df.orderBy(*order).limit(n)


def participant_trend(
    slots: DataFrame, participant: Column, metric: str, key: str = "participant_id"
) -> DataFrame:
    """One participant's metric over time."""
    return slots.where(F.col(key) == participant).select("time_format", metric).orderBy("time_format")

"""Shape of a table: declared types, names, columns, missing values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns under its names and types, in one projection.

    Names match without regard to case, a value that does not fit becomes NULL, other
    columns are dropped and a missing column is an error. Text such as `13.0` or `1e1` is
    a whole number: tables written with gaps in an integer column have it so.
    """
    texts = {name.lower() for name, kind in df.dtypes if kind == "string"}

    def cast(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        plain = column.try_cast(field.dataType)
        if isinstance(field.dataType, T.IntegralType) and field.name.lower() in texts:
            number = column.try_cast("double")
            plain = F.coalesce(plain, F.when(number == F.floor(number), number.try_cast(field.dataType)))
        return plain.alias(field.name)

    return df.select(*[cast(f) for f in schema.fields])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any column, or in any column of `subset`."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def parse_readings(df: DataFrame, value: str, time: str, time_type: str = "timestamp") -> DataFrame:
    """Cast text columns to a reading and drop rows where either does not parse."""
    parsed = df.withColumns(
        {
            value: F.col(value).try_cast("double"),
            time: F.col(time).try_cast(time_type),
        }
    )
    return drop_incomplete(parsed, [value, time])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def numeric_columns(df: DataFrame, leave_out: Iterable[str] = ()) -> list[str]:
    left_out = set(leave_out)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in left_out
    ]


def features_and_label(
    train: DataFrame, test: DataFrame, label: str, leave_out: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables cut to the label and the training table's numeric columns."""
    features = numeric_columns(train, [label, *leave_out])
    return train.select(*features, label), test.select(*features, label), features


def clean_number(name: str):
    """A numeric column with NaN counted as missing."""
    column = F.col(name)
    return F.when(~F.isnan(column), column)

"""Headed CSV and parquet tables.

CSV files are split between tasks, so a record must be a line. `write_table` therefore
marks line breaks within texts (`BREAKS`) and both readers turn the marks back. A file from
elsewhere whose quoted texts hold line breaks is read with `multiline=True`, by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.operators.conform import conform

# Written and read alike, so that timestamps survive to the microsecond.
CSV_OPTIONS = {
    "header": "true",
    # Quotes are doubled, blanks stay, NULL has a mark of its own beside an empty text.
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}

# The sign for an escape, U+241B, stands before a letter for itself, a line feed or a
# carriage return. It is marked first and turned back last, so any text comes back.
ESCAPE = "\u241b"
BREAKS = ((ESCAPE, f"{ESCAPE}e"), ("\n", f"{ESCAPE}n"), ("\r", f"{ESCAPE}r"))


def _texts(df: DataFrame, change) -> DataFrame:
    """`df` with `change` applied to its text columns."""
    columns = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields}
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[(change(c) if n in texts else c).alias(n) for n, c in columns.items()])


def mark_breaks(text: Column) -> Column:
    for plain, mark in BREAKS:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def turn_back_breaks(text: Column) -> Column:
    for plain, mark in reversed(BREAKS):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def is_csv(path: str) -> bool:
    return path.rstrip("/").lower().endswith(".csv")


def read_texts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A headed CSV with all its columns as text, line breaks turned back."""
    options = {**CSV_OPTIONS, "multiLine": str(multiline).lower()}
    return _texts(spark.read.options(**options).csv(path), turn_back_breaks)


def read_table(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """A table under its declared schema, CSV or parquet by the path's ending.

    CSV columns are taken by heading, not by position: only the heading is looked at
    up front, cells are read as text and cast. A cell that does not fit is NULL, and
    columns the schema does not name (such as a row index) are not read. `multiline` is for
    CSV whose quoted texts hold line breaks as they are; a file is then read by one task.
    """
    if is_csv(path):
        return conform(read_texts(spark, path, multiline), schema)
    return conform(spark.read.parquet(path), schema)


def read_csv_as_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV that `write_table` wrote: same columns in the same order, typed by the scan."""
    return _texts(spark.read.options(**CSV_OPTIONS).schema(schema).csv(path), turn_back_breaks)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None
) -> None:
    """Overwrite `path` with a headed CSV or parquet table, one part per task."""
    df = _texts(df, mark_breaks) if is_csv(path) else df
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_csv(path):
        writer.options(**{**CSV_OPTIONS, "emptyValue": '""'}).csv(path)
    else:
        writer.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)

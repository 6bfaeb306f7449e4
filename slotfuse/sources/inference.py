"""Types of columns that are known as text only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.operators.conform import conform
from slotfuse.sources.tables import read_texts

# Candidate types, from the narrowest; a text that fits one fits all wider numbers, and
# everything is a string. Forms are told by pattern, ranges by cast.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?Infinity|NaN)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
TRUTH = r"^(?i:true|false)$"
CANDIDATES: tuple[tuple[str, str], ...] = (
    ("int", WHOLE), ("bigint", WHOLE), ("double", NUMBER), ("date", DAY), ("timestamp_ntz", MOMENT), ("boolean", TRUTH),
)


def _fits(text: Column, kind: str, pattern: str) -> Column:
    return text.rlike(pattern) & text.try_cast(kind).isNotNull()


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, type, values: the narrowest type that all texts of a column fit, one row each.

    One pass: for each column and candidate the texts that do not fit are counted, which
    combines before it moves and is the same in any order. NULL fits every type; `values`
    counts the others, and a column without any is a string. An empty text is a string.
    """
    columns = list(df.columns if columns is None else columns)
    quoted = [F.col(f"`{c}`") for c in columns]
    misfits = [
        F.struct(
            F.lit(name).alias("column"), F.count(c).alias("values"),
            F.array(*[F.count_if(c.isNotNull() & ~_fits(c, kind, pattern)) for kind, pattern in CANDIDATES]).alias("misfits"),
        )
        for name, c in zip(columns, quoted)
    ]
    counted = df.agg(F.array(*misfits).alias("_rows")).select(F.inline("_rows"))
    first = F.array_position("misfits", F.lit(0).cast("long"))
    kind = F.get(F.array(*[F.lit(k) for k, _ in CANDIDATES]), (first - 1).cast("int"))
    return counted.select("column", F.when(F.col("values") > 0, F.coalesce(kind, F.lit("string"))).otherwise("string").alias("type"), "values")


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV of unknown types: read as text once to infer them, then under them."""
    texts = read_texts(spark, path)
    found = {r["column"]: r["type"] for r in infer_types(texts).collect()}  # one row a column
    return conform(texts, T.StructType.fromDDL(", ".join(f"`{c}` {found[c]}" for c in texts.columns)))

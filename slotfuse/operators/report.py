"""Scores of a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("string").alias("label"),
        F.col(prediction).cast("string").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """precision, recall, f1_score and support per class, then their summaries.

    Rows `accuracy` (all three scores equal), `macro avg` and `weighted avg` follow the
    classes. A ratio without cases is 0. The data is counted once; the rest works on
    one row per pair of classes.
    """
    n, hit = F.col("n"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("actual"),
            F.lit(0).cast("long").alias("predicted"),
            hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("actual"),
            n.alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    counts = (
        confusion_counts(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    precision, recall = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("actual"))
    f1 = ratio(2 * F.col("hits"), F.col("actual") + F.col("predicted"))

    def line(name, p, r, f, weight):
        return F.struct(
            name.alias("row"),
            p.cast("double").alias("p"),
            r.cast("double").alias("r"),
            f.cast("double").alias("f"),
            weight.cast("double").alias("weight"),
            F.col("actual").alias("actual"),
        )

    share = ratio(F.col("hits"), F.col("actual"))
    lines = F.array(
        line(F.col("class"), precision, recall, f1, F.lit(1)),
        line(F.lit("accuracy"), share, share, share, F.col("actual")),
        line(F.lit("macro avg"), precision, recall, f1, F.lit(1)),
        line(F.lit("weighted avg"), precision, recall, f1, F.col("actual")),
    )

    def mean(score):
        return ratio(F.sum(F.col(score) * F.col("weight")), F.sum("weight"))

    return (
        counts.select(F.inline(lines))
        .groupBy("row")
        .agg(
            mean("p").alias("precision"),
            mean("r").alias("recall"),
            mean("f").alias("f1_score"),
            F.sum("actual").alias("support"),
        )
    )

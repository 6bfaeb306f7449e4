"""Table-wide preparation: imputation, scaling, splitting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.operators.conform import clean_number

HASH_BITS = 32


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of `value`, each counting `weight` times; NULL without values."""
    total = F.sum(value * weight)
    return F.try_divide(total, F.sum(F.when(value.isNotNull(), weight)).cast("double"))


def impute_mean(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Replace NULL and NaN by the column's mean; a column without values stays NULL.

    The means come from `fit_on` (default: the table itself) and reach the rows as a
    scalar subquery. `copies` names a column saying how many equal rows a row stands for.
    """
    weight = F.col(copies) if copies else F.lit(1)
    source = df if fit_on is None else fit_on
    means = source.agg(
        F.struct(*[weighted_mean(clean_number(c), weight).alias(c) for c in columns]).alias("means")
    ).scalar()
    filled = {c: F.coalesce(clean_number(c), means[c]) for c in columns}
    return df.withColumns(filled)


def scaling(df: DataFrame, columns: Sequence[str]) -> Column:
    """Mean and population deviation per column, as one struct."""
    return df.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(clean_number(c)).alias("mean"),
                    F.stddev_pop(clean_number(c)).alias("deviation"),
                ).alias(c)
                for c in columns
            ]
        ).alias("scaling")
    ).scalar()


def standardise(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """(x - mean) / population deviation, fitted on `fit_on`; a constant column gives 0."""
    fitted = scaling(df if fit_on is None else fit_on, columns)

    def scaled(c: str) -> Column:
        centred = F.col(c) - fitted[c]["mean"]
        constant = fitted[c]["deviation"] == 0
        return F.when(constant, F.when(centred.isNotNull(), centred)).otherwise(
            F.try_divide(centred, fitted[c]["deviation"])
        )

    return df.withColumns({c: scaled(c) for c in columns})


def hash_bucket(keys: Sequence[str | Column], buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the md5 of the key text: same row, same bucket, any run."""
    return key_hash([F.col(k) if isinstance(k, str) else k for k in keys]) % buckets


def key_text(columns: Sequence[Column]) -> Column:
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return reduce(lambda a, b: F.concat(a, F.lit("|"), b), text)


def key_hash(columns: Sequence[Column]) -> Column:
    """`HASH_BITS` bits of the md5 of the key text."""
    return F.conv(F.substring(F.md5(key_text(columns)), 1, 8), 16, 10).cast("long")


def hash_split(
    df: DataFrame, keys: Sequence[str | Column], train_share: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Deterministic split in train and test; rows with equal keys stay together."""
    in_train = hash_bucket(keys) < train_share
    return df.where(in_train), df.where(~in_train)


def split_part(keys: Sequence[str | Column], train_share: int = 80) -> Column:
    """The part of `hash_split` a row falls in, `train` or `test`: one pass over its input."""
    return F.when(hash_bucket(keys) < train_share, "train").otherwise("test")


def stratified_parts(
    df: DataFrame, keys: Sequence[str], label: str, train_share: int = 80, coarse: int = 4096
) -> DataFrame:
    """`df` with `part`, `train` or `test`: of each class of `label` the share in train is exact.

    Rows with equal keys are one group and stay together; a group's class is its least
    label. Groups of a class are taken in the order of their hash until train has its share of
    the class's rows; it differs from that by half a group at most. The groups' order is
    found in two steps, a histogram of `coarse` bins of the hash per class and then the
    groups of one bin, so no task sees a whole class. The same rows give the same parts.
    NULL is a class of its own.
    """
    hashed = key_hash([F.col(k) for k in keys])
    rows = df.withColumns({"_hash": hashed, "_key": key_text([F.col(k) for k in keys])})
    width = (1 << HASH_BITS) // coarse
    groups = rows.groupBy("_key").agg(F.first("_hash").alias("_hash"), F.min(label).alias("_class"), F.count(F.lit(1)).alias("_n"))
    groups = groups.withColumns({"_bin": F.floor(F.col("_hash") / width), "_class": F.to_json(F.struct(F.col("_class").alias("c")))})
    bins = groups.groupBy("_class", "_bin").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("_class").orderBy("_bin")
    whole = Window.partitionBy("_class")
    placed = bins.select(
        "_class", "_bin", (F.sum("_n").over(before) - F.col("_n")).alias("_before"), F.sum("_n").over(before).alias("_after"),
        (F.sum("_n").over(whole) * train_share / 100).alias("_goal"),
    )
    # The bin in which the share is reached is looked at group by group; whole bins lie on either side.
    split = F.when(F.col("_after") <= F.col("_goal"), "train").when(F.col("_before") >= F.col("_goal"), "test")
    placed = placed.withColumn("_side", split)
    inside = groups.join(placed.where("_side is null"), ["_class", "_bin"])
    order = Window.partitionBy("_class").orderBy("_hash", "_key")
    taken = F.col("_before") + F.sum("_n").over(order) - F.col("_n") / 2
    inside = inside.select("_key", F.when(taken <= F.col("_goal"), "train").otherwise("test").alias("part"))
    outside = groups.join(placed.where("_side is not null"), ["_class", "_bin"]).select("_key", F.col("_side").alias("part"))
    return rows.join(outside.unionByName(inside), "_key").drop("_key", "_hash")

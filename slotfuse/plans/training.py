"""Train, apply and score the engagement classifier."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotfuse.operators.conform import clean_number, features_and_label
from slotfuse.operators.prepare import hash_bucket
from slotfuse.plans.boosting import BoostedTrees, Settings, fit_trees
from slotfuse.schemas import TARGET

# Identifiers are numbers too, but say nothing about a new participant.
IDENTIFIERS = ("class_id", "student_id")
ROW_KEYS = ("class_id", "student_id", "timestamp")
HELD_OUT = "_held_out"


def scaling_expressions(train: DataFrame, features: Sequence[str]) -> list[str]:
    """SQL for each feature, standardised by population deviation.

    A constant column becomes 0. A missing value is put one deviation below the least
    one, so trees can tell it apart. Only one row of statistics reaches the driver.
    """
    if not features:
        return []
    fitted = train.agg(
        *[
            F.struct(
                F.avg(clean_number(c)).alias("mean"),
                F.stddev_pop(clean_number(c)).alias("deviation"),
                F.min(clean_number(c)).alias("least"),
            ).alias(c)
            for c in features
        ]
    ).first()

    def scaled(c: str) -> str:
        mean, deviation, least = fitted[c]["mean"], fitted[c]["deviation"], fitted[c]["least"]
        if mean is None:
            return "0D"
        divisor = float(deviation) or 1.0
        missing = (float(least) - float(mean)) / divisor - 1.0
        number = f"nanvl(CAST(`{c}` AS DOUBLE), NULL)"
        return f"coalesce(({number} - {float(mean)!r}D) / {divisor!r}D, {missing!r}D)"

    return [scaled(c) for c in features]


def scaling_step(train: DataFrame, features: Sequence[str]) -> SQLTransformer:
    """`scaling_expressions` as a stage for a pipeline of Spark's own learners."""
    columns = ", ".join(f"{e} AS `{c}_scaled`" for c, e in zip(features, scaling_expressions(train, features)))
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def train_classifier(
    train: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    iterations: int = 300,
    learning_rate: float = 0.01,
    depth: int = 4,
    l2_leaf_reg: float = 3.0,
    validation_share: int = 10,
    patience: int = 50,
    folder: str | None = None,
) -> BoostedTrees:
    """Boosted trees on scaled features, as many as the held-out part of `train` is best with.

    The accuracy on the held-out rows is followed while the rest is fitted; the fit ends
    after `patience` rounds without gain and the best round's trees are kept. The held-out
    part is the rows whose `HELD_OUT` column is true, or a part by hash of all columns; if it is empty,
    or nothing else is left, all rows and all rounds count. Rows without a label are left
    out. The test table takes no part in the fit. There may be two labels or more; they come
    back as text in `prediction_label`. A fit that names a `folder` can be taken up there.
    """
    train = train.where(F.col(label).isNotNull())
    if HELD_OUT not in train.columns:
        train = train.withColumn(HELD_OUT, hash_bucket(train.columns) < validation_share)
    train = train.select(*features, F.col(label).cast("string").alias(label), HELD_OUT)
    parts = {r[0] for r in train.select(HELD_OUT).distinct().collect()}
    if parts != {True, False}:
        train = train.withColumn(HELD_OUT, F.lit(False))
    settings = Settings(iterations, learning_rate, depth, l2_leaf_reg, patience)
    scaled = list(zip(features, scaling_expressions(train, features)))
    return fit_trees(train, scaled, label, HELD_OUT, settings, folder)


def predict(model: BoostedTrees, test: DataFrame) -> DataFrame:
    return model.transform(test)


def fit_and_predict(
    train: DataFrame,
    test: DataFrame,
    label: str = TARGET,
    leave_out: Iterable[str] = IDENTIFIERS,
    **settings,
) -> tuple[BoostedTrees, DataFrame]:
    """Fit on the numeric columns of `train`, aligned with `test`; label and prediction.

    Rows are held out by their keys, if the table has them, so that equal features fall
    apart and a table with few distinct rows holds out its share too.
    """
    keys = [c for c in ROW_KEYS if c in train.columns]
    watch = hash_bucket(keys) < settings.get("validation_share", 10) if keys else None
    full = train
    train, test, features = features_and_label(train, test, label, leave_out)
    if watch is not None:
        train = full.select(*features, label, watch.alias(HELD_OUT))
    model = train_classifier(train, features, label, **settings)
    return model, predict(model, test).select(label, "prediction_label")

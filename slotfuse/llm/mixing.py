"""Mixing sources to target weights by capped water-filling.

Targets: every source gets words in proportion to its weight; a source that would have to
be repeated more than `max_epochs` times is clamped there, and what it cannot take is
shared by weight among the rest, until none is above its limit. With sources sorted by
limit over weight that fixed point is one pass over running sums, so it needs one row
per source and no loop.

Taking: a source's rate (target over size) is split into whole repetitions, which every
document gets, and a fraction, which is met by one more repetition of some documents:
those with the smallest seeded hash, up to the fraction of the source's words. The
threshold is found in two histograms of the hash (4,096 ranges, then 4,096 within the
range where the target falls), so no source is ever sorted in one task, however large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.llm.common import staged, words

SEED = "mix-1"
MAX_EPOCHS = 3
FINE, COARSE = 36, 48  # bits below the fine and the coarse range of a 60-bit hash


def row_hash(seed: str, doc_id: Column, text: Column) -> Column:
    """60 bits of an md5 over seed, id and text, so any engine can repeat it."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS, budget_share: float = 1.0
) -> DataFrame:
    """source_key, source_size, weight, target from one row per source.

    Weights repeat along the sources' order by code point, NULL last. The windows here
    hold one row per source, never documents.
    """
    by_key = Window.orderBy("source_key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limits = (
        sizes.withColumn("place", F.row_number().over(by_key) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    )
    everyone = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    running = limits.select(
        "*",
        (F.sum("source_size").over(everyone) * F.lit(float(budget_share))).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("clamped"),
        F.sum("weight").over(everyone).alias("all_weight"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("clamped_weight"),
    ).withColumn("level", (F.col("budget") - F.col("clamped")) / (F.col("all_weight") - F.col("clamped_weight")))
    open_ = F.col("cap") / F.col("weight") > F.col("level")
    order = F.struct(F.col("cap") / F.col("weight"), F.col("source_key"))
    level = F.min_by(F.when(open_, F.col("level")), F.when(open_, order)).over(everyone)
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return running.select("source_key", "source_size", "weight", target.alias("target"))


def _boundary(parts: DataFrame, goals: DataFrame, by: str) -> DataFrame:
    """For each source the range of `by` in which the running sum reaches the goal."""
    order = Window.partitionBy("source_key").orderBy(by)
    return (
        parts.groupBy("source_key", by).agg(F.sum("size").alias("words"))
        .withColumn("after", F.sum("words").over(order))
        .join(goals, "source_key")
        .where(F.col("after") >= F.col("goal"))
        .groupBy("source_key")
        .agg(F.min_by(F.struct(F.col(by).alias(by), (F.col("after") - F.col("words")).alias("done")), by).alias("b"),
             F.first("goal").alias("goal"))
        .select("source_key", f"b.{by}", (F.col("goal") - F.col("b.done")).alias("goal"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_epochs: int = MAX_EPOCHS,
    budget_share: float = 1.0,
    seed: str = SEED,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns `keep` of every row, with size, source_size, target, copies, taken.

    size counts words (NULL text: none); a NULL source is a source of its own, last in
    order. Each source's taken words differ from its target by half a document at most
    (rows equal in id and text share one fate and count as one document). A source
    without words has target 0. An empty table gives an empty table. Columns not named
    in `keep` are not read, and added columns replace ones of the same name.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    inner = {c: f"kept_{i}" for i, c in enumerate(c for c in keep if c not in added)}
    text = F.col("text")
    sized = staged(
        docs.select(
            *[F.col(f"`{c}`").alias(n) for c, n in inner.items()],
            F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("source_key"),
            F.size(words(text)).cast("long").alias("size"),
            row_hash(seed, F.col("doc_id"), text).alias("h"),
        ),
        "mix-sized",
    )
    sizes = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = staged(
        source_targets(sizes, weights, max_epochs, budget_share)
        .withColumn("whole", F.floor(rate).cast("long"))
        .withColumn("goal", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-plan",
    )
    ranged = sized.select("source_key", "size", "h", F.shiftright("h", COARSE).alias("coarse"), F.shiftright("h", FINE).alias("fine"))
    coarse = _boundary(ranged, plan.select("source_key", "goal"), "coarse")
    inside = ranged.join(coarse, ["source_key", "coarse"])
    fine = _boundary(inside.drop("goal"), coarse.select("source_key", "goal"), "fine")
    order = Window.partitionBy("source_key").orderBy("h")
    # One more document is taken while that brings the sum nearer to the goal.
    last = (
        inside.drop("goal").join(fine, ["source_key", "fine"])
        .groupBy("source_key", "h").agg(F.sum("size").alias("words"), F.first("goal").alias("goal"))
        .withColumn("after", F.sum("words").over(order))
        .where(F.col("after") - F.col("words") / 2 <= F.col("goal"))
        .groupBy("source_key").agg(F.max("h").alias("h"))
    )
    limits = staged(
        plan.join(fine.select("source_key", "fine"), "source_key", "left").join(last, "source_key", "left").select(
            "source_key", "source_size", "target", "whole",
            F.coalesce("h", F.shiftleft("fine", FINE) - 1, F.lit(-1)).cast("long").alias("up_to"),
        ),
        "mix-limits",
    )
    # Words alone count towards the boundary, so a text without any may lie below it at the most.
    copies = F.least(F.col("whole") + F.when(F.col("h") <= F.col("up_to"), 1).otherwise(0), F.lit(max_epochs).cast("long"))
    return sized.join(limits, "source_key").select(
        *[F.col(n).alias(c) for c, n in inner.items()], "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )

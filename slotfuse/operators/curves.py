"""What a plot draws around its points: a bootstrap band, a density curve."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.operators.conform import clean_number

# Weights come from multiplicative hashing modulo a prime: 28 bits of the row's key times
# 28 of the replicate's factor stay within a long.
PRIME = (1 << 31) - 1
KEY_DIGITS = 7


def replicate_constants(replicate: int) -> tuple[int, int]:
    """Factor and summand of one replicate's hash."""
    digits = hashlib.md5(f"replicate {replicate}".encode()).hexdigest()
    return 1 + int(digits[:KEY_DIGITS], 16), int(digits[KEY_DIGITS:2 * KEY_DIGITS], 16)


def poisson_limits(count: int = 10) -> list[int]:
    """A hash below the k-th limit, and no limit before it, is a weight of k."""
    limits, total, term = [], 0.0, 0.36787944117144233  # e^-1
    for k in range(count):
        total += term
        limits.append(int(total * PRIME))
        term /= k + 1
    return limits


def key_number(keys: Sequence[str]) -> Column:
    """28 bits of the md5 of the key columns' text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, KEY_DIGITS), 16, 10).cast("long")


def bootstrap_band(
    df: DataFrame, by: str, value: str, keys: Sequence[str], replicates: int = 200, level: float = 95.0
) -> DataFrame:
    """Mean of `value` per `by`, with the percentiles of its bootstrapped means as a band.

    Every row stands in a replicate as often as a Poisson number from the hash of its
    `keys` and the replicate says, so replicates are weighted sums that combine before they
    are shuffled, and a second run gives the same band. A row is unfolded once a replicate;
    what moves is one pair of sums a task, group and replicate. Missing values are left
    out; a replicate without rows of a group takes no part in its band.
    """
    factors, summands = zip(*map(replicate_constants, range(replicates)))
    constants = F.arrays_zip(
        F.sequence(F.lit(0), F.lit(replicates - 1)).alias("r"),
        F.array(*map(F.lit, factors)).alias("a"), F.array(*map(F.lit, summands)).alias("b"),
    )
    rows = df.select(F.col(by), clean_number(value).cast("double").alias("_v"), key_number(keys).alias("_key")).where("_v is not null")
    each = rows.select(by, "_v", "_key", F.explode(constants).alias("_c"))
    drawn = (F.col("_key") * F.col("_c.a").cast("long") + F.col("_c.b")) % PRIME
    weight = sum((F.when(drawn >= limit, 1).otherwise(0) for limit in poisson_limits()), F.lit(0))
    sums = each.select(by, "_v", F.col("_c.r").alias("_r"), weight.alias("_w")).groupBy(by, "_r").agg(
        F.sum(F.col("_w") * F.col("_v")).alias("_total"), F.sum("_w").alias("_n"), F.sum("_v").alias("_plain"), F.count("_v").alias("_rows")
    )
    side = (100 - level) / 200
    mean = F.try_divide("_total", F.col("_n").cast("double"))
    return sums.groupBy(by).agg(
        (F.first("_plain") / F.first("_rows")).alias("mean"),
        F.percentile(mean, F.lit(side)).alias("lower"), F.percentile(mean, F.lit(1 - side)).alias("upper"),
    )


def density_curve(df: DataFrame, column: str, points: int = 128) -> DataFrame:
    """point, x, density: a Gaussian kernel density on an even grid from least to greatest value.

    The width is Scott's, the sample deviation times n^(-1/5). Values are shared out
    linearly between their two neighbours on the grid, so one aggregate of at most `points`
    numbers a task is all that moves, and the kernel runs over the grid alone. Fewer than
    two different values have no curve.
    """
    number = clean_number(column).cast("double")
    facts = df.agg(
        F.struct(
            F.min(number).alias("lo"), F.max(number).alias("hi"), F.count(number).cast("double").alias("n"),
            F.stddev_samp(number).alias("deviation"),
        ).alias("facts")
    ).where("facts.lo < facts.hi").scalar()
    step = (facts["hi"] - facts["lo"]) / (points - 1)
    at = (number - facts["lo"]) / step
    low = F.when(at.isNotNull(), F.least(F.floor(at), F.lit(points - 2))).cast("int")  # `least` skips NULL
    shared = df.where(number.isNotNull()).select(low.alias("low"), (at - low).alias("over")).where("low is not null")
    halves = F.explode(F.array(
        F.struct(F.col("low").alias("point"), (1 - F.col("over")).alias("mass")),
        F.struct((F.col("low") + 1).alias("point"), F.col("over").alias("mass")),
    ))
    grid = shared.select(halves.alias("h")).groupBy("h.point").agg(F.sum("h.mass").alias("mass"))
    width = facts["deviation"] * F.pow(facts["n"], F.lit(-0.2))
    reached = grid.select("mass", F.col("point").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    distance = (F.col("point") - F.col("own")) * step / width
    kernel = F.exp(-0.5 * distance * distance) / (width * facts["n"] * F.sqrt(2 * F.pi()))
    return reached.select("point", (facts["lo"] + F.col("point") * step).alias("x"), (F.col("mass") * kernel).alias("part")).groupBy("point", "x").agg(
        F.sum("part").alias("density")
    )

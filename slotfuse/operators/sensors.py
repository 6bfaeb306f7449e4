"""Sensor channels averaged into slots and put side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.functions.timeslots import SLOT_SECONDS, floor_to_slot, slot_of_day
from slotfuse.sources.sensor_files import path_keys

GAP_STRETCH = 4096  # slots of a gap that are unfolded in one piece


def slot_means(df: DataFrame, keys: Sequence[str], slot: Column, value: str, name: str) -> DataFrame:
    """Mean of one channel per key and slot; `slot` names the slot column."""
    return df.groupBy(*keys, slot).agg(F.avg(value).alias(name))


def wide_slot_means(
    readings: DataFrame,
    keys: Sequence[str],
    channels: Mapping[str, str],
    channel: str = "channel",
    value: str = "value",
    keep_stray: bool = True,
) -> DataFrame:
    """All channels in one pass: a row per key, a mean per channel.

    The same rows as averaging each channel alone and joining the results full outer,
    from one scan and one exchange of partial sums. A channel that never occurs keeps
    its column, all NULL.

    `keep_stray` keeps rows with a NULL in the keys apart by channel, as a join would.
    Ahead of an inner join on the keys, which drops those rows, it should be off: the
    result is then partitioned by the keys alone and the join moves it no more.
    """
    readings = readings.where(F.col(channel).isin(*channels))
    means = [
        F.avg(F.when(F.col(channel) == code, F.col(value))).alias(name)
        for code, name in channels.items()
    ]
    return _by_keys(readings, keys, channel, keep_stray, means)


def merge_channels(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of channels that each have one row per key.

    Stacks the frames and regroups once, instead of one outer join after another
    (each of which would shuffle the growing left side again).
    """
    names = list(frames)
    stacked = reduce(
        DataFrame.unionByName,
        [
            frame.select(
                *keys,
                F.lit(name).alias("_channel"),
                *[(F.col(n) if n == name else F.lit(None).cast("double")).alias(n) for n in names],
            )
            for name, frame in frames.items()
        ],
    )
    return _by_keys(stacked, keys, "_channel", True, [F.max(n).alias(n) for n in names])


def _by_keys(
    df: DataFrame, keys: Sequence[str], channel: str, keep_stray: bool, aggregates: list[Column]
) -> DataFrame:
    """Group by the keys; rows without a full key by channel as well, if they are kept.

    NULL keys do not join, so such rows of different channels never share a row.
    """
    incomplete = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if not keep_stray:
        return df.where(~incomplete).groupBy(*keys).agg(*aggregates)
    stray = F.when(incomplete, F.col(channel)).alias("_stray")
    return df.groupBy(*keys, stray).agg(*aggregates).drop("_stray")


def sensor_slots(
    readings: DataFrame, channels: Mapping[str, str], keep_stray: bool = True, absolute: bool = False
) -> DataFrame:
    """Readings of a file tree -> class_id, participant_id, slot (seconds) and the means.

    With `absolute` a slot is its starting time, so days stay apart.

    Sums are first taken per file and slot, so the path is taken apart once per slot
    and not once per reading.
    """
    return slots_of_sums(file_slot_sums(readings, absolute), channels, keep_stray)


def file_slot_sums(readings: DataFrame, absolute: bool = False, *versions: str) -> DataFrame:
    """Readings -> sums per file and slot: class_id, participant_id, channel, slot, total, n, source.

    `versions` names columns that a file has one value of; they stay beside its sums.
    """
    timed = readings.where(F.col("Time").isNotNull())
    slot = floor_to_slot(F.col("Time")) if absolute else slot_of_day(F.col("Time"))
    per_file = timed.groupBy("source", *versions, slot.alias("slot")).agg(
        F.sum(F.col("value").cast("double")).alias("total"), F.count("value").alias("n")
    )
    # Generated columns: a filter on plain ones would be moved below the aggregation,
    # by a later filter or join, and match paths per reading again.
    return per_file.select("slot", "total", "n", "source", *versions, F.inline(F.array(F.struct(*path_keys()))))


def slots_of_sums(sums: DataFrame, channels: Mapping[str, str], keep_stray: bool = True) -> DataFrame:
    """Sums per file and slot -> one row per class, participant and slot with the means."""
    keys = ["class_id", "participant_id", "slot"]

    def mean(code: str) -> Column:
        here = F.col("channel") == code
        total = F.sum(F.when(here, F.col("total")))
        return F.try_divide(total, F.sum(F.when(here, F.col("n"))))

    keyed = sums.where(F.col("channel").isin(*channels))
    means = [mean(code).alias(name) for code, name in channels.items()]
    return _by_keys(keyed, keys, "channel", keep_stray, means)


def dense_slots(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    name: str,
    width: int = SLOT_SECONDS,
) -> DataFrame:
    """Mean per key and slot with empty slots kept as NULL, first to last slot of a key.

    Only slot means are moved; each fills the gap up to the next one of its key, so no
    second table of all slots is built and joined.
    """
    start = F.window(F.col(time), f"{width} seconds")["start"].alias("slot_start")
    means = df.groupBy(*keys, start).agg(F.avg(value).alias(name))
    filled = fill_gaps(means, keys, width)
    return filled.select(*keys, "slot_start", F.when(~F.col("filled"), F.col(name)).alias(name))


def dense_channels(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    channels: Mapping[str, str],
    channel: str = "channel",
    value: str = "value",
    width: int = SLOT_SECONDS,
) -> DataFrame:
    """All channels resampled densely, each from its own first to last slot, side by side on time.

    The rows of `merge_channels` over one `dense_slots` a channel, from one scan, one
    window and one conditional aggregate.
    """
    start = F.window(F.col(time), f"{width} seconds")["start"].alias("slot_start")
    read = df.where(F.col(channel).isin(*channels))
    means = read.groupBy(*keys, channel, start).agg(F.avg(value).alias("_mean"))
    filled = fill_gaps(means, [*keys, channel], width)
    own = [F.max(F.when((F.col(channel) == code) & ~F.col("filled"), F.col("_mean"))).alias(name) for code, name in channels.items()]
    return _by_keys(filled, [*keys, "slot_start"], channel, True, own)


def fill_gaps(means: DataFrame, keys: Sequence[str], width: int = SLOT_SECONDS, stretch: int = GAP_STRETCH) -> DataFrame:
    """Rows of (keys, slot_start, more) with the slots up to each key's next row added, `filled`.

    A gap is cut into stretches of at most `stretch` slots. Stretches are dealt over all
    tasks before they are unfolded into slots, so neither one row nor one key with a gap of
    years is more than its share of a task. Added rows repeat the other columns.
    """
    by_key = Window.partitionBy(*keys).orderBy("slot_start")
    later = means.withColumn("_next", F.lead("slot_start").over(by_key))
    if dict(means.dtypes)["slot_start"] == "timestamp_ntz":  # clock time: no session zone may come in
        seconds = F.expr("cast(cast(_next - slot_start as interval second) as decimal(18, 0))")
    else:
        seconds = F.unix_seconds("_next") - F.unix_seconds("slot_start")
    slots = F.coalesce((seconds / width).cast("long"), F.lit(1).cast("long"))
    cut = later.withColumn("_slots", slots).withColumn("_stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / stretch))))
    # A stated number: by size, a few stretches would be merged into one task and unfolded there.
    tasks = int(means.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = cut.repartition(tasks, *[F.col(k) for k in keys], "slot_start", "_stretch")
    first = F.col("_stretch") * stretch
    last = F.least(first + stretch, F.col("_slots")) - 1
    each = cut.withColumn("_slot", F.explode(F.sequence(first, last)))
    return each.withColumns({
        "filled": F.col("_slot") > 0,
        "slot_start": F.col("slot_start") + F.make_dt_interval(secs=F.col("_slot") * width),
    }).drop("_next", "_slots", "_stretch", "_slot")

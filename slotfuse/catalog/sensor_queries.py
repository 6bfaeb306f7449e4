"""Slots, windows and channel merging over `events`."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotfuse.catalog import standins
from slotfuse.catalog.registry import query, rounded, table
from slotfuse.catalog.standins import EVENT_CHANNELS, SQL_CHANNEL_MEANS, SQL_CLOCK, with_views
from slotfuse.functions.timeslots import clock_text, floor_to_slot, time_of_day
from slotfuse.operators import profile
from slotfuse.operators.conform import with_constants
from slotfuse.operators.sensors import dense_channels, dense_slots, merge_channels, slot_means, wide_slot_means

_MEANS = list(EVENT_CHANNELS.values())
_SQL_ROUNDED = ", ".join(f"round({m},6) as {m}" for m in _MEANS)
_SQL_WIDE = f"""select participant_id, time_format, {_SQL_ROUNDED} from (
    select cast(user_id as int) as participant_id, {SQL_CLOCK.format('sl')} as time_format,
    {SQL_CHANNEL_MEANS} from ev group by 1,2)"""


@query(
    with_views(
        f"""select event_type, cast(user_id as int) as participant_id,
        {SQL_CLOCK.format('sl')} as time_format, round(avg(value),6) as mean
        from ev group by 1,2,3""",
        "ev",
    )
)
def sensor_window_mean(spark, sf_dir):
    """Mean of a channel per participant and five minutes of the day."""
    means = slot_means(
        standins.readings(spark, sf_dir), ["event_type", "participant_id"], F.col("slot"), "value", "mean"
    )
    return rounded(
        means.select("event_type", "participant_id", clock_text(F.col("slot")).alias("time_format"), "mean"),
        ["mean"],
    )


@query(
    """select event_type, user_id, time_bucket(interval 5 minute, ts) as start,
    time_bucket(interval 5 minute, ts) + interval 5 minute as finish,
    round(avg(value),6) as mean from events group by 1,2,3,4"""
)
def tumbling_absolute(spark, sf_dir):
    """The same on absolute time, half open, empty windows absent."""
    windows = slot_means(
        table(spark, sf_dir, "events"),
        ["event_type", "user_id"],
        F.window("ts", "5 minutes"),
        "value",
        "mean",
    )
    return rounded(
        windows.select(
            "event_type",
            "user_id",
            F.col("window.start").alias("start"),
            F.col("window.end").alias("finish"),
            "mean",
        ),
        ["mean"],
    )


@query(with_views(_SQL_WIDE, "ev"))
def sensor_single_pass(spark, sf_dir):
    """Five channels side by side from one scan."""
    wide = wide_slot_means(
        standins.readings(spark, sf_dir), ["participant_id", "slot"], EVENT_CHANNELS, channel="event_type"
    )
    return rounded(
        wide.select("participant_id", clock_text(F.col("slot")).alias("time_format"), *_MEANS), _MEANS
    )


@query(with_views(_SQL_WIDE, "ev"))
def sensor_outer_fold(spark, sf_dir):
    """Five channels averaged apart, then merged full outer."""
    readings = standins.readings(spark, sf_dir)
    channels = {
        name: slot_means(
            readings.where(F.col("event_type") == code), ["participant_id"], F.col("slot"), "value", name
        )
        for code, name in EVENT_CHANNELS.items()
    }
    wide = merge_channels(channels, ["participant_id", "slot"])
    return rounded(
        wide.select("participant_id", clock_text(F.col("slot")).alias("time_format"), *_MEANS), _MEANS
    )


def _dense_sql(source: str, keys: str) -> str:
    on = " and ".join(f"s.{k.strip()}=m.{k.strip()}" for k in keys.split(","))
    return f"""means as (select {keys}, time_bucket(interval 5 minute, ts) as slot_start, avg(value) as mean
        from {source} group by all),
    spans as (select {keys}, unnest(generate_series(min(slot_start), max(slot_start), interval 5 minute)) as slot_start
        from means group by {keys}),
    dense as (select s.*, m.mean from spans s left join means m on {on} and s.slot_start=m.slot_start)"""


_SESSIONS = "days as (select *, cast(ts as date) as day from events)"


@query(
    f"""with {_SESSIONS}, {_dense_sql('days', 'user_id, day')}
    select user_id, day, slot_start, round(mean,6) as mean from dense"""
)
def resample_dense(spark, sf_dir):
    """Five-minute means of each participant's day, empty slots kept."""
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return rounded(dense_slots(days, ["user_id", "day"], "ts", "value", "mean"), ["mean"])


@query(
    f"""with {_SESSIONS}, {_dense_sql('days', 'user_id, day, event_type')}
    select cast(user_id as int) as participant_id, day, strftime(slot_start,'%H:%M:%S') as time_format,
    {", ".join(f"round(max(case when event_type='{code}' then mean end),6) as {name}" for code, name in EVENT_CHANNELS.items())}
    from dense group by 1,2,3"""
)
def session_concat(spark, sf_dir):
    """All channels resampled apart and laid side by side on time."""
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    keys = ["user_id", "day"]
    merged = dense_channels(days, keys, "ts", EVENT_CHANNELS, "event_type")
    return rounded(
        merged.select(
            F.col("user_id").cast("int").alias("participant_id"),
            "day",
            time_of_day(F.col("slot_start")).alias("time_format"),
            *_MEANS,
        ),
        _MEANS,
    )


@query(
    with_views(
        f"""select time_format, round(hr_mean,6) as hr_mean from (
            select user_id, {SQL_CLOCK.format('sl')} as time_format, {SQL_CHANNEL_MEANS} from ev group by 1,2)
        where user_id = (select user_id from events group by 1 order by count(*) desc, user_id limit 1)
        order by time_format""",
        "ev",
    )
)
def participant_trend(spark, sf_dir):
    """One participant's metric over time; here the one with most readings."""
    readings = standins.readings(spark, sf_dir)
    most = (
        profile.group_count(readings, "participant_id")
        .agg(F.max_by("participant_id", F.struct("count", -F.col("participant_id"))))
        .scalar()
    )
    wide = wide_slot_means(readings, ["participant_id", "slot"], EVENT_CHANNELS, channel="event_type")
    slots = wide.withColumn("time_format", clock_text(F.col("slot")))
    return rounded(profile.participant_trend(slots, most, "hr_mean"), ["hr_mean"])


@query("select event_id, strftime(ts,'%H:%M:%S') as time_format from events", name="time_of_day")
def time_of_day_text(spark, sf_dir):
    """date_format: the clock text of a timestamp."""
    return table(spark, sf_dir, "events").select("event_id", time_of_day(F.col("ts")).alias("time_format"))


@query("select event_id, time_bucket(interval 5 minute, ts) as slot_start from events")
def floor_5min(spark, sf_dir):
    """Timestamps rounded down to five minutes."""
    return table(spark, sf_dir, "events").select("event_id", floor_to_slot(F.col("ts")).alias("slot_start"))


@query("select event_id, value, 1 as class_id, 'HR' as channel from events")
def constant_columns(spark, sf_dir):
    """Key columns added as constants."""
    return with_constants(
        table(spark, sf_dir, "events").select("event_id", "value"), {"class_id": 1, "channel": "HR"}
    )


@query("select event_type, user_id, ts, event_id from events order by event_type, user_id, ts")
def sort_multi_key(spark, sf_dir):
    """O2: ascending on three keys."""
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id")
    return events.orderBy("event_type", "user_id", "ts")


@query("select event_id, ts, value from events order by ts, event_id limit 5")
def preview_topn(spark, sf_dir):
    """O3: the first five rows."""
    return profile.preview(table(spark, sf_dir, "events").select("event_id", "ts", "value"), 5, "ts", "event_id")

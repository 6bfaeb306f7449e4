"""CSV sources and sinks, on test tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotfuse.catalog import standins
from slotfuse.catalog.registry import query, rounded, table
from slotfuse.catalog.standins import SQL_CLOCK, with_views
from slotfuse.functions.timeslots import with_clock_text
from slotfuse.operators.sensors import sensor_slots
from slotfuse.schemas import CHANNELS, MEANS
from slotfuse.plans import upkeep
from slotfuse.sources import inference
from slotfuse.sources.sensor_files import read_readings, with_path_keys
from slotfuse.sources.staging import fresh_path
from slotfuse.sources.tables import CSV_OPTIONS, read_csv_as_written, write_table

# channel codes by the event type that stands for them
_CODES = dict(zip(standins.EVENT_CHANNELS, CHANNELS))
_SQL_CODE = "case event_type " + " ".join(f"when '{e}' then '{c}'" for e, c in _CODES.items()) + " end"
_SQL_TREE = f"""tree as (select wd+1 as class_id, wk as participant_id, {_SQL_CODE} as channel,
    ts as "Time", cast(value as real) as value, sl from ev)"""


def _with_tree(sql: str) -> str:
    return with_views("", "ev").rstrip() + ",\n" + _SQL_TREE + "\n" + sql


def _sensor_tree(spark, sf_dir, events="true", root=None) -> str:
    """Events as sensor files, class and participant being weekday and week; joins a tree at `root`."""
    root = root or fresh_path(spark, "wearables")
    code = F.element_at(F.create_map(*[F.lit(x) for pair in _CODES.items() for x in pair]), F.col("event_type"))
    readings = standins.readings(spark, sf_dir).where(events).select(
        "value",
        F.col("ts").alias("Time"),
        (F.col("wd") + 1).alias("class_id"),
        F.col("wk").alias("participant_id"),
        code.alias("channel"),
    )
    # A folder's readings come together before they are written; large folders are split again.
    readings = spark.sql(
        "select /*+ rebalance(class_id, participant_id, channel) */ * from {readings}", readings=readings
    )
    options = {**CSV_OPTIONS, "header": "false"}
    readings.write.mode("append").options(**options).partitionBy("class_id", "participant_id", "channel").csv(root)
    return root


@query("select * from orders")
def csv_headed_roundtrip(spark, sf_dir):
    """A table written as headed CSV and read under its schema."""
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "orders") + ".csv"
    write_table(orders, path)
    return read_csv_as_written(spark, path, orders.schema)


@query("select * from documents")
def csv_text_roundtrip(spark, sf_dir):
    """Texts with line breaks, quotes and blanks through CSV and back."""
    documents = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "documents") + ".csv"
    write_table(documents, path)
    return read_csv_as_written(spark, path, documents.schema)


@query(_with_tree('select class_id, participant_id, channel, "Time", value from tree'))
def csv_glob_sensor(spark, sf_dir):
    """All headless sensor files of a tree as one table."""
    readings = read_readings(spark, _sensor_tree(spark, sf_dir), time_type="timestamp_ntz")
    return with_path_keys(readings).select("class_id", "participant_id", "channel", "Time", "value")


@query(_with_tree("select class_id, participant_id, channel, count(*) as readings from tree group by 1,2,3"))
def path_keys(spark, sf_dir):
    """S3: keys taken from the files' paths, once per file."""
    readings = read_readings(spark, _sensor_tree(spark, sf_dir), time_type="timestamp_ntz")
    per_file = readings.groupBy("source").agg(F.count("*").alias("n"))
    keys = ["class_id", "participant_id", "channel"]
    return with_path_keys(per_file).groupBy(*keys).agg(F.sum("n").alias("readings"))


_SQL_SLOTS = f"""select class_id, participant_id, {SQL_CLOCK.format('sl')} as time_format, """ + ", ".join(
    f"round(avg(case when channel='{c}' then cast(value as double) end),6) as {name}" for c, name in CHANNELS.items()
)


@query(_with_tree(f"{_SQL_SLOTS} from tree group by 1,2,3"))
def sensor_file_slots(spark, sf_dir):
    """Sensor files to one row per class, participant and slot."""
    readings = read_readings(spark, _sensor_tree(spark, sf_dir), time_type="timestamp_ntz")
    return rounded(with_clock_text(sensor_slots(readings, CHANNELS), "slot", "time_format"), MEANS)


_SQL_ABSOLUTE = _SQL_SLOTS.replace(
    f"{SQL_CLOCK.format('sl')} as time_format", "time_bucket(interval '5 minutes', \"Time\") as slot"
)


@query(_with_tree(f"{_SQL_ABSOLUTE} from tree group by 1,2,3"))
def sensor_file_absolute(spark, sf_dir):
    """Sensor files to slots on absolute time, days apart."""
    readings = read_readings(spark, _sensor_tree(spark, sf_dir), time_type="timestamp_ntz")
    return rounded(sensor_slots(readings, CHANNELS, absolute=True), MEANS)


@query(_with_tree(f"{_SQL_SLOTS}, cast(null as double) as gsr_mean from tree group by 1,2,3"))
def channel_or_empty(spark, sf_dir):
    """A channel without any file keeps its column, all NULL."""
    channels = {**CHANNELS, "gsr": "gsr_mean"}
    readings = read_readings(spark, _sensor_tree(spark, sf_dir), channels, "timestamp_ntz")
    return rounded(with_clock_text(sensor_slots(readings, channels), "slot", "time_format"), MEANS)


@query(_with_tree(f"{_SQL_SLOTS} from tree group by 1,2,3"))
def slots_kept_up_to_date(spark, sf_dir):
    """Slots from a store that two loads of a growing tree of files have filled."""
    store = fresh_path(spark, "store")
    root = _sensor_tree(spark, sf_dir, "value < 50")
    upkeep.update_store(spark, root, store, time_type="timestamp_ntz")
    _sensor_tree(spark, sf_dir, "value >= 50 or value is null", root)
    upkeep.update_store(spark, root, store, time_type="timestamp_ntz")
    return rounded(with_clock_text(upkeep.stored_slots(spark, store), "slot", "time_format"), MEANS)


_UNTYPED = {
    "whole": ("cast(o_orderkey as string)", "cast(o_orderkey as varchar)"),
    "wide": ("cast(o_orderkey * 10000000000 as string)", "cast(cast(o_orderkey as bigint) * 10000000000 as varchar)"),
    "number": ("cast(o_totalprice as string)", "cast(o_totalprice as varchar)"),
    "day": ("cast(cast(o_orderdate as date) as string)", "cast(cast(o_orderdate as date) as varchar)"),
    "moment": ("concat(cast(cast(o_orderdate as date) as string), ' 10:15:00')", "cast(cast(o_orderdate as date) as varchar) || ' 10:15:00'"),
    "truth": ("if(o_orderkey % 2 = 0, 'true', 'False')", "if(o_orderkey % 2 = 0, 'true', 'False')"),
    "text": ("o_orderpriority", "o_orderpriority"),
    "nothing": ("cast(null as string)", "cast(null as varchar)"),
    "gaps": ("if(o_orderkey % 3 = 0, null, cast(o_custkey as string))", "if(o_orderkey % 3 = 0, null, cast(o_custkey as varchar))"),
    "mixed": ("if(o_orderkey % 97 = 0, 'n/a', cast(o_custkey as string))", "if(o_orderkey % 97 = 0, 'n/a', cast(o_custkey as varchar))"),
    "widened": ("if(o_orderkey % 97 = 0, '1.5e3', cast(o_custkey as string))", "if(o_orderkey % 97 = 0, '1.5e3', cast(o_custkey as varchar))"),
}
_PATTERNS = {  # of the candidate types, narrowest first
    "int": "'^[+-]?[0-9]+$') and try_cast({0} as int) is not null",
    "bigint": "'^[+-]?[0-9]+$') and try_cast({0} as bigint) is not null",
    "double": "'^[+-]?[0-9.]+([eE][+-]?[0-9]+)?$') and try_cast({0} as double) is not null",
    "date": "'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') and try_cast({0} as date) is not null",
    "timestamp_ntz": "'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}( [0-9:]+)?$') and try_cast({0} as timestamp) is not null",
    "boolean": "'^(?i:true|false)$')",
}


def _inferred_sql() -> str:
    def one(name: str) -> str:
        whens = " ".join(
            f"when bool_and({name} is null or coalesce(regexp_matches({name}, {p.format(name)}, false)) then '{kind}'" for kind, p in _PATTERNS.items()
        )
        return f"select '{name}' as \"column\", case when count({name}) = 0 then 'string' {whens} else 'string' end as type, count({name}) as \"values\" from t"

    columns = ", ".join(f"{sql} as {name}" for name, (_, sql) in _UNTYPED.items())
    return f"with t as (select {columns} from orders) " + " union all ".join(map(one, _UNTYPED))


@query(_inferred_sql())
def infer_types(spark, sf_dir):
    """The narrowest type of each column of a table of texts, in one pass."""
    texts = table(spark, sf_dir, "orders").selectExpr(*[f"{expression} as `{name}`" for name, (expression, _) in _UNTYPED.items()])
    return inference.infer_types(texts)


@query("select o_orderkey, o_custkey, o_totalprice, cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders")
def csv_inferred_roundtrip(spark, sf_dir):
    """A headed CSV of unknown types read back under those that its cells show."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority"
    )
    path = fresh_path(spark, "untyped") + ".csv"
    write_table(orders, path)
    back = inference.read_inferred(spark, path)
    # Keys come back as the narrowest whole numbers.
    return back.withColumns({c: F.col(c).cast(t) for c, t in orders.dtypes if t == "bigint"})

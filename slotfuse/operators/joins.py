"""Joins that keep the large side where it is and do not depend on even keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bound for a broadcast whose size Spark cannot estimate (an exploded table).
MAX_BROADCAST_BYTES = 64 << 20
BUCKET_SECONDS = 1800

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DatetimeType)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's rows in memory, by one aggregate over it."""
    free = [f.name for f in df.schema.fields if not isinstance(f.dataType, _FIXED_WIDTH)]
    text = [F.sum(F.octet_length(F.col(f"`{c}`").cast("string"))) for c in free]
    sizes = df.agg(F.count("*") * (16 + 8 * len(df.columns)), *text).first()
    return sum(size or 0 for size in sizes)


def broadcast_if_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast after measuring; beyond the bound, a sort-merge join that AQE may split.

    For tables behind an explode, where the optimizer's estimate is that of the table
    before it. All other joins are left to the optimizer's own size check.
    """
    if measured_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df.hint("merge")


def keep_left_join(left: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer join of a small or even table with a large, uneven one.

    Split in the inner join and the rows without partner. A plain outer join can
    neither broadcast nor split its preserved side against a hot key in `facts`; the
    inner part can do both, and the other part needs only the distinct keys.
    """
    keys = list(keys)
    matched = left.join(facts, keys, "inner")
    alone = left.join(facts.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[tuple[str, str]],
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    bucket: int = BUCKET_SECONDS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join points to the intervals they lie in, both ends included.

    `on` pairs equal columns (point side, interval side); `point`, `start` and `end`
    are whole numbers, such as seconds of the day. Intervals are repeated per bucket
    they touch, which makes the bucket part of the hash key: each point meets only
    intervals of its own bucket.

    `how='right'` also keeps intervals without points, with NULLs on the point side.
    """
    if how not in ("inner", "right"):
        raise ValueError(f"interval_join cannot do {how!r}")
    first, last = F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket)
    spread = intervals.where(F.col(start) <= F.col(end)).withColumn(
        "_bucket", F.explode(F.sequence(first, last))
    )
    with_bucket = points.withColumn("_point_bucket", F.floor(F.col(point) / bucket))

    def meets(left: DataFrame, right: DataFrame) -> list:
        return [
            *[left[p] == right[i] for p, i in on],
            left["_point_bucket"] == right["_bucket"],
            left[point] >= right[start],
            left[point] <= right[end],
        ]

    small = broadcast_if_bounded(spread, max_broadcast_bytes)
    matched = with_bucket.join(small, meets(with_bucket, small), "inner").drop(
        "_bucket", "_point_bucket"
    )
    if how == "inner":
        return matched

    # Whether an interval has a point depends on its keys and ends alone, and is
    # settled against the distinct points: at most one per key and second.
    ends = [*[i for _, i in on], start, end]
    moments = with_bucket.select(*[p for p, _ in on], point, "_point_bucket").distinct()
    places = spread.select(*ends, "_bucket").distinct()
    busy = places.join(moments, meets(moments, places), "left_semi").select(*ends).distinct()
    idle = intervals.join(busy, ends, "left_anti")
    return matched.unionByName(idle, allowMissingColumns=True)


def dyadic_nodes(first: Column, last: Column, levels: int) -> Column:
    """The nodes (level, index) of a binary tree over whole numbers that tile first..last.

    A node of level l covers 2^l numbers. There are at most two a level, so a range of n
    numbers has at most 2 log2(n) of them (one, if it is one number).
    """
    def odd(x: Column) -> Column:
        return F.pmod(x, F.lit(2).cast("long")) == 1

    def climb(state: Column, level: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        takes_low = odd(lo) & (lo < hi)
        up = F.when(takes_low, lo + 1).otherwise(lo)
        takes_high = odd(hi) & (up < hi)
        down = F.when(takes_high, hi - 1).otherwise(hi)
        level = level.cast("int").alias("level")
        here = F.array_compact(F.array(
            F.when(takes_low, F.struct(level, lo.alias("index"))), F.when(takes_high, F.struct(level, down.alias("index")))
        ))
        return F.struct(F.shiftright(up, 1).alias("lo"), F.shiftright(down, 1).alias("hi"), F.concat(state["nodes"], here).alias("nodes"))

    start = F.struct(
        first.cast("long").alias("lo"), (last.cast("long") + 1).alias("hi"),
        F.array().cast("array<struct<level:int,index:bigint>>").alias("nodes"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), start, climb, lambda state: state["nodes"])


def dyadic_interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[tuple[str, str]],
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    finest: int = BUCKET_SECONDS,
    levels: int = 48,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """`interval_join` for intervals of any length: the same arguments and rows.

    An interval becomes the dyadic nodes that tile it, over buckets of `finest`, so a long
    one is some tens of rows and not one for each bucket. A point climbs from its bucket
    through those levels on which some interval has a node; it meets an interval in exactly
    one node, so no pair is found twice. Both ends are checked afterwards.
    """
    if how not in ("inner", "right"):
        raise ValueError(f"dyadic_interval_join cannot do {how!r}")
    first, last = F.floor(F.col(start) / finest), F.floor(F.col(end) / finest)
    spread = intervals.where(F.col(start) <= F.col(end)).withColumn("_node", F.explode(dyadic_nodes(first, last, levels)))
    spread = spread.withColumns({"_level": F.col("_node.level"), "_index": F.col("_node.index")}).drop("_node")
    used = sorted(r[0] for r in spread.select("_level").distinct().collect())  # at most `levels` numbers
    climbs = F.array(*[F.lit(i) for i in used]) if used else F.array().cast("array<int>")
    bucket = F.floor(F.col(point) / finest).cast("long")

    def climbed(df: DataFrame) -> DataFrame:
        df = df.withColumn("_point_level", F.explode(climbs))
        return df.withColumn("_point_index", F.expr("shiftright(_bucket, _point_level)")).drop("_bucket")

    def meets(left: DataFrame, right: DataFrame) -> list:
        return [
            *[left[p] == right[i] for p, i in on], left["_point_level"] == right["_level"], left["_point_index"] == right["_index"],
            left[point] >= right[start], left[point] <= right[end],
        ]

    extra = ["_level", "_index", "_point_level", "_point_index"]
    lifted = climbed(points.withColumn("_bucket", bucket))
    small = broadcast_if_bounded(spread, max_broadcast_bytes)
    matched = lifted.join(small, meets(lifted, small), "inner").drop(*extra)
    if how == "inner":
        return matched
    ends = [*[i for _, i in on], start, end]
    moments = climbed(points.select(*[p for p, _ in on], point).distinct().withColumn("_bucket", bucket))
    places = spread.select(*ends, "_level", "_index").distinct()
    busy = places.join(moments, meets(moments, places), "left_semi").select(*ends).distinct()
    return matched.unionByName(intervals.join(busy, ends, "left_anti"), allowMissingColumns=True)

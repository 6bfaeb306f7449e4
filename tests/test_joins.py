"""Joins against the plain Spark join they stand for, and against brute force."""

import random

import pytest

from slotfuse.operators import joins

ON = [("week", "class_week")]


def points(spark, n=400, seed=3):
    rng = random.Random(seed)
    data = [
        (i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, 4000, rng.randrange(0, 20000)]))
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "id int, week int, second int")


INTERVALS = [
    (1, 1, 0, 4000),
    (2, 1, 4000, 9000),
    (3, 1, 4001, 4001),
    (4, 2, 1800, 3600),
    (5, 2, 9000, 100),  # ends before it starts
    (6, 3, 0, 20000),
    (6, 3, 0, 20000),  # twice the same
    (7, 9, 0, 20000),  # week without points
    (8, None, 0, 20000),
    (9, 1, None, 20000),
]


def brute_force(data, how):
    pairs = [
        (p[0], i[0])
        for i in INTERVALS
        for p in data
        if None not in (p[1], p[2], i[1], i[2], i[3]) and p[1] == i[1] and i[2] <= p[2] <= i[3]
    ]
    if how == "right":
        hit = {i for _, i in pairs}
        pairs += [(None, i[0]) for i in INTERVALS if i[0] not in hit]
    return sorted(pairs, key=str)


@pytest.mark.parametrize("how", ["inner", "right"])
@pytest.mark.parametrize("bucket", [60, 1800, 100_000])
@pytest.mark.parametrize("bound", [0, 10_000])
def test_interval_join(spark, how, bucket, bound):
    data, p = points(spark)
    i = spark.createDataFrame(INTERVALS, "class_id int, class_week int, start int, finish int")
    df = joins.interval_join(p, i, ON, "second", "start", "finish", how, bucket, bound)
    assert df.columns == ["id", "week", "second", "class_id", "class_week", "start", "finish"]
    assert sorted(((r["id"], r["class_id"]) for r in df.collect()), key=str) == brute_force(data, how)


def test_interval_join_right_equals_plain_right_join(spark, rows):
    _, p = points(spark, seed=8)
    i = spark.createDataFrame(INTERVALS, "class_id int, class_week int, start int, finish int")
    plain = p.join(
        i, (p.week == i.class_week) & (p.second >= i.start) & (p.second <= i.finish), "right"
    )
    assert rows(joins.interval_join(p, i, ON, "second", "start", "finish", "right")) == rows(plain)


def test_dropping_null_rows_makes_the_right_join_inner(spark, rows):
    _, p = points(spark, seed=5)
    i = spark.createDataFrame(INTERVALS, "class_id int, class_week int, start int, finish int")
    right = joins.interval_join(p, i, ON, "second", "start", "finish", "right").na.drop()
    assert rows(right) == rows(joins.interval_join(p, i, ON, "second", "start", "finish"))


def test_interval_join_refuses_other_kinds(spark):
    _, p = points(spark)
    with pytest.raises(ValueError):
        joins.interval_join(p, p, ON, "second", "second", "second", "full")


def test_broadcast_only_within_the_bound(spark):
    small = spark.createDataFrame([(1, "abc"), (2, None), (3, "äb")], "i int, s string")
    assert joins.measured_bytes(small) == 3 * 32 + 6
    assert joins.measured_bytes(small.where("i > 9")) == 0
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(joins.broadcast_if_bounded(small, 102))
    assert "merge" in plan(joins.broadcast_if_bounded(small, 101))


def test_keep_left_join_equals_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, name string")
    facts = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (4, 8), (None, 9)], "k int, v int")
    assert rows(joins.keep_left_join(left, facts, ["k"])) == rows(left.join(facts, "k", "left"))


def test_joins_stay_whole_when_a_key_is_split_as_skewed(spark, rows):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(100).withColumnRenamed("id", "k")
        facts = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 90) as k", "id as v")
        df = joins.keep_left_join(left, facts, ["k"])
        assert rows(df) == rows(left.join(facts, "k", "left"))
        matched = left.join(facts, "k")
        matched.collect()
        assert "skew=true" in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

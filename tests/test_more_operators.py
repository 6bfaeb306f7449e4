"""Dyadic joins, bounded gaps, bands, curves, types, exact shares and slots kept up to date."""

import math
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slotfuse.operators.curves import PRIME, bootstrap_band, density_curve, poisson_limits
from slotfuse.operators.joins import dyadic_interval_join, dyadic_nodes, interval_join
from slotfuse.operators.prepare import stratified_parts
from slotfuse.operators.sensors import dense_channels, dense_slots, fill_gaps, merge_channels
from slotfuse.plans import jobs, upkeep
from slotfuse.sources.inference import infer_types, read_inferred


def test_nodes_tile_an_interval_once(spark):
    rng = random.Random(1)
    spans = [(a, a + n) for a in (-70, -1, 0, 5, 1023) for n in (0, 1, 2, 7, 64, 1000, rng.randint(0, 10**6))]
    df = spark.createDataFrame(spans, "a long, b long").withColumn("nodes", dyadic_nodes(F.col("a"), F.col("b"), 48))
    for r in df.collect():
        nodes = sorted((n["index"] << n["level"], (n["index"] + 1) << n["level"]) for n in r["nodes"])
        assert nodes[0][0] == r["a"] and nodes[-1][1] == r["b"] + 1
        assert all(x[1] == y[0] for x, y in zip(nodes, nodes[1:]))
        assert len(nodes) <= max(1, 2 * math.log2(r["b"] - r["a"] + 1))


@pytest.mark.parametrize("how", ["inner", "right"])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_dyadic_join_equals_the_flat_one(spark, rows, how, limit):
    rng = random.Random(2)
    points = [(i, rng.randint(0, 2), rng.randint(-500, 90_000)) for i in range(300)] + [(900, None, 5), (901, 1, None)]
    spans = [(i, rng.randint(0, 2), s, s + rng.choice([-1, 0, 30, 4000, 10**6])) for i, s in enumerate(rng.randint(-900, 86_400) for _ in range(60))]
    spans += [(700, None, 0, 9), (701, 1, None, 9), (702, 2, 10**9, 10**9 + 5)]
    p = spark.createDataFrame(points, "pid int, day int, at long")
    s = spark.createDataFrame(spans, "sid int, on_day int, s long, e long")
    arguments = ([("day", "on_day")], "at", "s", "e", how)
    got = dyadic_interval_join(p, s, *arguments, finest=60, max_broadcast_bytes=limit)
    want = interval_join(p, s, *arguments, bucket=1 << 20)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        dyadic_interval_join(p, s, [("day", "on_day")], "at", "s", "e", "left")


def test_a_gap_of_years_is_spread_over_tasks(spark):
    start = datetime(2014, 1, 1)
    data = [(1, start, 1.0), (1, start + timedelta(days=3650), 2.0), (2, start, 3.0), (2, start + timedelta(minutes=15), 4.0)]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v double")
    out = dense_slots(df, ["k"], "t", "v", "m")
    counts = {r[0]: r[1] for r in out.groupBy("k").agg(F.struct(F.count("*").alias("n"), F.count("m").alias("m"))).collect()}
    assert tuple(counts[1]) == (3650 * 288 + 1, 2) and tuple(counts[2]) == (4, 2)
    means = df.groupBy("k", F.window("t", "5 minutes")["start"].alias("slot_start")).agg(F.avg("v").alias("m"))
    sizes = [r[0] for r in fill_gaps(means, ["k"]).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_gaps_do_not_depend_on_the_zone(spark, rows):
    data = [(1, datetime(2020, 3, 8, 1, 0), 1.0), (1, datetime(2020, 3, 8, 4, 0), 2.0)]  # clocks go forward between
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        clock = dense_slots(spark.createDataFrame(data, "k int, t timestamp_ntz, v double"), ["k"], "t", "v", "m")
        assert clock.count() == 37 and clock.where("m is not null").count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    moments = dense_slots(spark.createDataFrame(data, "k int, t timestamp, v double"), ["k"], "t", "v", "m")
    assert moments.count() == 37


def test_dense_channels_equal_merged_single_ones(spark, rows):
    rng = random.Random(4)
    start = datetime(2020, 1, 1)
    data = [(rng.choice([1, 2, None]), rng.choice("abz"), start + timedelta(minutes=rng.randint(0, 500)), rng.choice([None, 1.0, 2.5])) for _ in range(80)]
    df = spark.createDataFrame(data, "k int, ch string, t timestamp_ntz, v double")
    names = {"a": "a_mean", "b": "b_mean", "c": "c_mean"}
    got = dense_channels(df, ["k"], "t", names, "ch", "v")
    parts = {name: dense_slots(df.where(F.col("ch") == code), ["k"], "t", "v", name) for code, name in names.items()}
    want = merge_channels(parts, ["k", "slot_start"])
    assert got.columns == want.columns and rows(got) == rows(want)


def test_poisson_weights_and_bootstrap(spark):
    limits = poisson_limits()
    assert limits == sorted(limits) and limits[-1] < PRIME and limits[0] / PRIME == pytest.approx(math.exp(-1), rel=1e-6)
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 50).cast("double").alias("v"))
    df = df.unionByName(spark.createDataFrame([(9000, 0, None), (9001, 7, 5.0), (9002, 8, float("nan"))], df.schema))
    got = {r["g"]: r for r in bootstrap_band(df, "g", "v", ["id"], 400).collect()}
    assert set(got) == {0, 1, 7}
    for g, deviation in ((0, 14.42), (1, 14.42)):
        half = 1.96 * deviation / math.sqrt(1000)
        assert got[g]["upper"] - got[g]["lower"] == pytest.approx(2 * half, rel=0.25)
        assert got[g]["lower"] < got[g]["mean"] < got[g]["upper"]
    assert (got[7]["mean"], got[7]["lower"], got[7]["upper"]) == (5.0, 5.0, 5.0)
    again = {r["g"]: r for r in bootstrap_band(df.repartition(7), "g", "v", ["id"], 400).collect()}
    assert again[0]["lower"] == pytest.approx(got[0]["lower"])
    assert bootstrap_band(df.limit(0), "g", "v", ["id"]).count() == 0


def test_density_is_near_the_exact_kernel_sum(spark):
    rng = random.Random(5)
    values = [rng.gauss(3, 1) for _ in range(300)] + [rng.gauss(9, 0.5) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    n, mean = len(values), sum(values) / len(values)
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1)) * n ** -0.2
    curve = density_curve(df, "v", 256).orderBy("point").collect()
    assert [r["point"] for r in curve] == list(range(256))
    for r in curve:
        exact = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in values) / (n * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(exact, rel=1e-3, abs=1e-5)
    assert density_curve(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").count() == 0
    assert density_curve(df.limit(0), "v").count() == 0


def test_types_of_texts(spark, tmp_path):
    cells = {
        "a": ["1", "-2", "+3"], "b": ["1", "3000000000", None], "c": ["1", "2.5", "1e3"], "d": ["2020-01-01", None, "2020-02-29"],
        "e": ["2020-01-01", "2020-01-01 10:00:00", "2020-01-01T10:00:00.5"], "f": ["true", "FALSE", None], "g": ["1", "", "2"],
        "h": [None, None, None], "i": ["2020-02-30", None, None], "j": ["NaN", "1", "-Infinity"], "k": ["99999999999999999999", "1", None], "l": ["1d", "2", "3"],
    }
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    want = dict(zip(cells, "int bigint double date timestamp_ntz boolean string string string double double string".split()))
    got = {r["column"]: r["type"] for r in infer_types(df.repartition(3)).collect()}
    assert got == want
    assert {r["type"] for r in infer_types(df.limit(0)).collect()} == {"string"}
    text = "x,y\n" + "\n".join(f"{i},{'' if i % 2 else i / 2}" for i in range(9))
    (tmp_path / "t.csv").write_text(text)
    back = read_inferred(spark, f"{tmp_path}/t.csv")
    assert dict(back.dtypes)["x"] == "int" and back.agg(F.sum("x")).first()[0] == 36


def test_every_class_has_its_share(spark, rows):
    rng = random.Random(6)
    data = [(g, rng.choice(["a"] * 30 + ["b"] * 5 + ["c", None])) for g in range(900) for _ in range(rng.randint(1, 4))]
    data += [(10_000, "b")] * 60 + [(20_000 + i, "rare") for i in range(5)]
    df = spark.createDataFrame(data, "g int, c string")
    for coarse in (4096, 4):
        out = stratified_parts(df, ["g"], "c", 80, coarse)
        assert rows(out.drop("part")) == rows(df)
        kept = out.groupBy("g").agg(F.count_distinct("part").alias("n")).where("n > 1")
        assert kept.count() == 0
    classes = out.join(df.groupBy("g").agg(F.min("c").alias("own"), F.count("*").alias("size")), "g")
    for r in classes.groupBy("own").agg(F.count("*").alias("n"), F.count_if(F.col("part") == "train").alias("t"), F.max("size").alias("most")).collect():
        assert abs(r["t"] - 0.8 * r["n"]) <= r["most"] / 2
    assert stratified_parts(df.limit(0), ["g"], "c").count() == 0


def write(path, lines, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("\n".join(lines) + "\n")
    when = time.time() - age
    os.utime(path, (when, when))


def test_slots_of_two_loads_equal_one(spark, tmp_path, rows):
    root, store = f"{tmp_path}/tree", f"{tmp_path}/store"
    assert upkeep.update_store(spark, root, store) == 0 and upkeep.stored_slots(spark, store).count() == 0
    write(f"{root}/1/1/HR.csv", ["60,2020-01-01 09:00:00", "70,2020-01-01 09:01:00"], 90)
    write(f"{root}/1/2/TEMP.csv", ["30,2020-01-01 09:00:00"], 90)
    assert upkeep.update_store(spark, root, store) == 2
    assert upkeep.update_store(spark, root, store) == 0
    write(f"{root}/1/1/EDA.csv", ["5,2020-01-01 09:04:59", "bad,2020-01-01 09:04:59"], 60)
    write(f"{root}/2/1/HR.csv", ["80,2020-01-01 09:00:00"], 60)
    assert upkeep.update_store(spark, root, store) == 2

    def full():
        from slotfuse.operators.sensors import sensor_slots
        from slotfuse.schemas import CHANNELS
        from slotfuse.sources.sensor_files import read_readings

        return rows(sensor_slots(read_readings(spark, root), CHANNELS))

    assert rows(upkeep.stored_slots(spark, store)) == full()
    write(f"{root}/1/1/HR.csv", ["60,2020-01-01 09:00:00", "70,2020-01-01 09:01:00", "80,2020-01-01 09:02:00"], 30)  # sent again
    assert upkeep.update_store(spark, root, store) == 1
    assert rows(upkeep.stored_slots(spark, store)) == full()
    assert len(full()) == 3


def test_a_lost_update_is_done_again(spark, tmp_path, rows, monkeypatch):
    root, store = f"{tmp_path}/tree", f"{tmp_path}/store"
    write(f"{root}/1/1/HR.csv", ["60,2020-01-01 09:00:00"], 90)
    upkeep.update_store(spark, root, store)
    write(f"{root}/1/2/HR.csv", ["70,2020-01-01 09:00:00"], 60)
    monkeypatch.setattr(upkeep, "LEDGER", "no such type")
    with pytest.raises(Exception):
        upkeep.update_store(spark, root, store)
    monkeypatch.undo()
    spark.read.parquet(f"{store}/sums").write.mode("append").parquet(f"{tmp_path}/copy")
    assert upkeep.update_store(spark, root, store) == 1
    out = upkeep.stored_slots(spark, store)
    assert sorted(r["hr_mean"] for r in out.collect()) == [60.0, 70.0]


def test_the_upkeep_stage(spark, tmp_path):
    root = f"{tmp_path}/tree"
    write(f"{root}/1/1/HR.csv", ["60,2020-01-01 09:00:00"], 90)
    jobs.main(["upkeep", root, f"{tmp_path}/store", f"{tmp_path}/slots"])
    assert [r["hr_mean"] for r in spark.read.parquet(f"{tmp_path}/slots").collect()] == [60.0]

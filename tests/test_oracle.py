"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry
from check import connect, differences
from slotfuse.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = {"train_engagement"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_only_the_learner_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    count, wrong = differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name])
    assert not wrong
    assert count > 0


def test_training_scores_both_levels(spark):
    report = {r["row"]: r for r in QUERIES["train_engagement"](spark, SF_DIR).collect()}
    assert {"Engaged", "Not Engaged", "accuracy", "macro avg", "weighted avg"} <= set(report)
    assert report["Engaged"]["support"] + report["Not Engaged"]["support"] == report["accuracy"]["support"]


def test_entry_gives_the_fused_table(spark):
    df = entry(spark)
    assert df.columns[0] == "class_id" and df.columns[-1] == "engagement_level"
    assert df.count() > 0


@pytest.mark.parametrize(
    "name",
    ["flagship_fusion", "tumbling_absolute", "resample_dense", "class_duration_stats", "csv_glob_sensor", "floor_5min"],
)
def test_results_do_not_depend_on_the_session_zone(spark, db, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name])[1] == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fusion_shuffles_each_side_once_for_mean_and_rows(spark):
    df = QUERIES["flagship_fusion"](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan

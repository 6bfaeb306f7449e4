"""Scaling, splitting, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotfuse.catalog import standins
from slotfuse.catalog.registry import query, rounded, table
from slotfuse.operators.conform import numeric_columns
from slotfuse.operators.prepare import hash_split, split_part, standardise, stratified_parts
from slotfuse.operators.report import classification_report as report
from slotfuse.plans import fusion, jobs, survey, training
from slotfuse.plans.boosting import BoostedTrees
from slotfuse.sources.staging import fresh_path
from slotfuse.sources.tables import read_table, write_json, write_table

_SQL_BUCKET = "cast('0x' || substr(md5(cast({0} as varchar)),1,8) as bigint) % 100"


@query(
    """select event_id, round((value - avg_value)/dev,6) as value from events,
    (select avg(value) as avg_value, stddev_pop(value) as dev from events)"""
)
def zscore(spark, sf_dir):
    """M2: standardised by population deviation."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(standardise(events, ["value"]), ["value"])


@query(
    f"""with parts as (select *, {_SQL_BUCKET.format('event_id')} < 80 as fit from events)
    select event_id, round((value - (select avg(value) from parts where fit)) /
    (select stddev_pop(value) from parts where fit),6) as value from parts where not fit"""
)
def zscore_fit_on_train(spark, sf_dir):
    """M2: scaling fitted on the training part, applied to the test part."""
    train, test = hash_split(table(spark, sf_dir, "events").select("event_id", "value"), ["event_id"])
    return rounded(standardise(test, ["value"], fit_on=train), ["value"])


@query(
    f"""select doc_id, quality, case when {_SQL_BUCKET.format('doc_id')} < 80 then 'train' else 'test' end as part
    from labels""",
    name="hash_split",
)
def hash_split_parts(spark, sf_dir):
    """M3: every row in exactly one part, the same in every run."""
    return table(spark, sf_dir, "labels").select("doc_id", "quality", split_part(["doc_id"]).alias("part"))


@query(
    """with g as (select o_custkey as k, min(o_orderstatus) as c, count(*) as n,
        cast('0x' || substr(md5(cast(o_custkey as varchar)), 1, 8) as bigint) as h from orders group by 1),
    t as (select k, sum(n) over (partition by c order by h, cast(k as varchar) rows unbounded preceding) - n / 2.0 as taken,
        sum(n) over (partition by c) * 80 / 100.0 as goal from g)
    select o_orderkey, case when taken <= goal then 'train' else 'test' end as part from orders join t on o_custkey = k"""
)
def stratified_split(spark, sf_dir):
    """M3: exact shares of every class, a customer's orders together."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return stratified_parts(orders, ["o_custkey"], "o_orderstatus").select("o_orderkey", "part")


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")


@query(
    f"""select part, toxic, n_chars, quality from (select *,
    case when {_SQL_BUCKET.format('l.doc_id')} < 80 then 'train' else 'test' end as part
    from labels l join documents d on l.doc_id=d.doc_id)"""
)
def numeric_features(spark, sf_dir):
    """Label split off, numeric columns kept, test aligned with train."""
    rows = _labelled(spark, sf_dir)
    return rows.select(split_part(["doc_id"]).alias("part"), *numeric_columns(rows, ["quality", "doc_id"]), "quality")


_SQL_REPORT = """with scored as (select cast(quality as varchar) as label,
        case when length(text) >= 500 then '1' else '0' end as prediction
        from labels l join documents d on l.doc_id=d.doc_id),
    classes as (select label as class from scored union select prediction from scored),
    counts as (select class, (select count(*) from scored where label=class) as actual,
        (select count(*) from scored where prediction=class) as predicted,
        (select count(*) from scored where label=class and prediction=class) as hits from classes),
    per_class as (select class, actual, hits, case when predicted=0 then 0 else hits/predicted end as p,
        case when actual=0 then 0 else hits/actual end as r,
        case when actual+predicted=0 then 0 else 2*hits/(actual+predicted) end as f from counts),
    rows as (select class as "row", p, r, f, actual as support from per_class
    union all select 'accuracy', sum(hits)/sum(actual), sum(hits)/sum(actual), sum(hits)/sum(actual), sum(actual) from per_class
    union all select 'macro avg', avg(p), avg(r), avg(f), sum(actual) from per_class
    union all select 'weighted avg', sum(p*actual)/sum(actual), sum(r*actual)/sum(actual), sum(f*actual)/sum(actual), sum(actual) from per_class)
    select "row", round(cast(p as double),6) as precision, round(cast(r as double),6) as recall,
    round(cast(f as double),6) as f1_score, cast(support as bigint) as support from rows"""


@query(_SQL_REPORT)
def classification_report(spark, sf_dir):
    """Report of a fixed rule (long texts are good) against the labels."""
    # The rule is applied before the join, so no text is shuffled.
    rule = F.when(F.length("text") >= 500, 1).otherwise(0).alias("prediction")
    scored = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", rule), "doc_id")
    scored = scored.select("quality", "prediction")
    return rounded(report(scored, "quality", "prediction"), ["precision", "recall", "f1_score"])


@query(_SQL_REPORT)
def metrics_json(spark, sf_dir):
    """The report written as JSON and read back."""
    metrics = classification_report(spark, sf_dir)
    path = fresh_path(spark, "metrics") + ".json"
    write_json(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@query(
    f"""select cast(c_custkey as int) as student_id,
    case when 12 + c_custkey % 6 >= 15 then 'Engaged' else 'Not Engaged' end as prediction_label
    from customer where {_SQL_BUCKET.format('c_custkey')} >= 80"""
)
def predict_rule(spark, sf_dir):
    """Trees learn a rule from a stored table; saved, loaded, applied to the rest."""
    level = F.when(F.col("Age") >= 15, "Engaged").otherwise("Not Engaged").alias("engagement_level")
    rows = standins.students(spark, sf_dir).select(F.col("Pid").alias("student_id"), F.col("Age").alias("age"), level)
    folder = fresh_path(spark, "rule")
    for name, part in zip(("train", "test"), hash_split(rows, ["student_id"])):
        write_table(part, f"{folder}/{name}")
    stored, rest = (read_table(spark, f"{folder}/{name}", rows.schema) for name in ("train", "test"))
    model = training.train_classifier(stored, ["age"], iterations=10, learning_rate=0.1)
    model.save(spark, f"{folder}/model")
    scored = training.predict(BoostedTrees.load(spark, f"{folder}/model"), rest)
    return scored.select("student_id", "prediction_label")


@query()
def train_engagement(spark, sf_dir):
    """Fused table split and stored, boosted trees fitted, saved and scored."""
    participants = survey.counted_participants(
        standins.students(spark, sf_dir), standins.surveys(spark, sf_dir), standins.timetable(spark, sf_dir)
    )
    folder = fresh_path(spark, "engagement")
    fused, train, test = (f"{folder}/{name}.csv" for name in ("fused", "train", "test"))
    write_table(fusion.fuse(standins.device_slots(spark, sf_dir), participants), fused)
    jobs.prepare(spark, fused, train, test)
    metrics = jobs.train(spark, train, test, folder, folder)
    return rounded(metrics, ["precision", "recall", "f1_score"])

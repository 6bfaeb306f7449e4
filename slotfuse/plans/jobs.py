"""The batch stages, each callable on URIs and from the command line.

    python -m slotfuse.plans.jobs fuse PARTICIPANTS SURVEY CLASSES WEARABLES OUT
    python -m slotfuse.plans.jobs prepare FUSED TRAIN_OUT TEST_OUT
    python -m slotfuse.plans.jobs train --train-data .. --test-data .. \
        --model-output-dir .. --metric-output-dir ..

`fuse` is `sensors` and `participants` followed by `combine`, which can be run alone:

    python -m slotfuse.plans.jobs sensors WEARABLES OUT
    python -m slotfuse.plans.jobs upkeep WEARABLES STORE OUT
    python -m slotfuse.plans.jobs participants PARTICIPANTS SURVEY CLASSES OUT
    python -m slotfuse.plans.jobs combine SLOTS PARTICIPANTS OUT

`explore` writes statistics of the three raw tables as parquet tables beside each other:

    python -m slotfuse.plans.jobs explore PARTICIPANTS SURVEY CLASSES OUT

`fuse` and `prepare` also take the project of the gs:// connector before their paths.
Paths may lie on any Hadoop file system. A path that ends in `.csv` is a headed CSV
table, any other a parquet table.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse import schemas
from slotfuse.functions.timeslots import with_clock_text
from slotfuse.operators.prepare import hash_split, impute_mean
from slotfuse.operators.report import classification_report
from slotfuse.operators.sensors import sensor_slots
from slotfuse.plans import explore as exploration
from slotfuse.plans import fusion, survey, training
from slotfuse.plans import upkeep as stored
from slotfuse.session import build_session
from slotfuse.sources.sensor_files import read_readings
from slotfuse.sources.staging import staging
from slotfuse.sources.tables import read_table, write_json, write_table

log = logging.getLogger(__name__)


def _inside(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def load_students(spark: SparkSession, participant_dir: str) -> DataFrame:
    student = read_table(spark, _inside(participant_dir, "student.csv"), schemas.STUDENT)
    return student.withColumnsRenamed(schemas.STUDENT_SHORT_NAMES)


def load_survey_tables(
    spark: SparkSession, participant_dir: str, survey_dir: str, class_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Students, answers and timetable."""
    return (
        load_students(spark, participant_dir),
        read_table(spark, _inside(survey_dir, "student_survey.csv"), schemas.STUDENT_SURVEY),
        read_table(spark, _inside(class_dir, "class_table.csv"), schemas.CLASS_TABLE),
    )


def sensors(spark: SparkSession, wearable_dir: str, out: str) -> None:
    """Sensor files -> the table of slot means, in order."""
    slots = sensor_slots(read_readings(spark, wearable_dir), schemas.CHANNELS)
    ordered = slots.orderBy("class_id", "participant_id", "slot")
    write_table(with_clock_text(ordered, "slot", "time_format"), out)


def upkeep(spark: SparkSession, wearable_dir: str, store: str, out: str) -> None:
    """Sensor files that are new since the last run join the store; all its slots, in order."""
    count = stored.update_store(spark, wearable_dir, store)
    log.info("%d files read", count)
    ordered = stored.stored_slots(spark, store).orderBy("class_id", "participant_id", "slot")
    write_table(with_clock_text(ordered, "slot", "time_format"), out)


def participants(
    spark: SparkSession, participant_dir: str, survey_dir: str, class_dir: str, out: str
) -> None:
    """Students, answers and timetable -> the participant survey table."""
    tables = load_survey_tables(spark, participant_dir, survey_dir, class_dir)
    write_table(survey.participant_survey(*tables), out)


def combine(spark: SparkSession, slots: str, participants: str, out: str) -> None:
    """The two tables as `sensors` and `participants` wrote them -> the fused table."""
    fused = fusion.fuse_tables(
        read_table(spark, slots, schemas.SENSOR_SLOTS),
        read_table(spark, participants, schemas.PARTICIPANT_SURVEY),
    )
    write_table(fused, out)


def fuse(
    spark: SparkSession,
    participant_dir: str,
    survey_dir: str,
    class_dir: str,
    wearable_dir: str,
    out: str,
) -> None:
    """Raw tables and sensor files -> the fused table.

    Both sides are far smaller than what they come from and are staged, so raw files
    are read once and never again, even if executors are lost in the joins. The staged
    tables are deleted once the fused one is written.
    """
    slots = sensor_slots(read_readings(spark, wearable_dir), schemas.CHANNELS, keep_stray=False)
    answered = survey.counted_participants(
        *load_survey_tables(spark, participant_dir, survey_dir, class_dir)
    )
    with staging(spark) as stage:
        write_table(fusion.fuse(stage(slots, "slots"), stage(answered, "participants")), out)


def explore(
    spark: SparkSession, participant_dir: str, survey_dir: str, class_dir: str, out: str
) -> None:
    """Students, answers and timetable -> statistics, one parquet table each under `out`.

    Each raw table is parsed once and staged; a report then reads its own columns only.
    """
    tables = load_survey_tables(spark, participant_dir, survey_dir, class_dir)
    with staging(spark) as stage:
        student, answers, timetable = (stage(t, "explore") for t in tables)
        reports = {
            **exploration.student_reports(student),
            **exploration.questionnaire_reports(answers),
            **exploration.timetable_reports(timetable),
        }
        for name, report in reports.items():
            write_table(report, _inside(out, name))


def prepare(
    spark: SparkSession,
    fused: str,
    train_out: str,
    test_out: str,
    train_share: int = 80,
    impute_on_train: bool = False,
) -> None:
    """Fused table -> train and test; a participant's slot always falls on the same side.

    With `impute_on_train` means that are still missing become those of the train part.
    """
    rows = read_table(spark, fused, schemas.FUSED)
    keys = ["class_id", "student_id", "timestamp"]
    train, test = hash_split(rows, keys, train_share)
    if impute_on_train:
        train, test = (impute_mean(part, schemas.MEANS, fit_on=train) for part in (train, test))
    write_table(train, train_out)
    write_table(test, test_out)


def train(
    spark: SparkSession,
    train_data: str,
    test_data: str,
    model_output_dir: str,
    metric_output_dir: str,
    iterations: int = 300,
    learning_rate: float = 0.01,
    depth: int = 4,
    l2_leaf_reg: float = 3.0,
    keep_identifiers: bool = False,
    fit_dir: str | None = None,
) -> DataFrame:
    """Train and test tables -> saved model, metrics as JSON; returns the metrics.

    A run that names a `fit_dir` goes on from the rounds that an earlier one staged there.
    """
    model, scored = training.fit_and_predict(
        read_table(spark, train_data, schemas.FUSED),
        read_table(spark, test_data, schemas.FUSED),
        leave_out=() if keep_identifiers else training.IDENTIFIERS,
        iterations=iterations,
        learning_rate=learning_rate,
        depth=depth,
        l2_leaf_reg=l2_leaf_reg,
        folder=fit_dir,
    )
    log.info("%d rounds kept", len(model.rounds))
    model.save(spark, _inside(model_output_dir, "model"))
    metrics = classification_report(
        scored.where(F.col(schemas.TARGET).isNotNull()), schemas.TARGET, "prediction_label"
    )
    write_json(metrics, _inside(metric_output_dir, "metrics.json"))
    return spark.read.schema(metrics.schema).json(_inside(metric_output_dir, "metrics.json"))


STAGES = {
    "sensors": sensors,
    "upkeep": upkeep,
    "participants": participants,
    "combine": combine,
    "explore": explore,
    "fuse": fuse,
    "prepare": prepare,
    "train": train,
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="slotfuse.plans.jobs")
    parser.add_argument("--project", help="project of the gs:// connector, if one is used")
    stages = parser.add_subparsers(dest="stage", required=True)
    positional = {
        "fuse": ("participant_dir", "survey_dir", "class_dir", "wearable_dir", "out"),
        "sensors": ("wearable_dir", "out"),
        "upkeep": ("wearable_dir", "store", "out"),
        "participants": ("participant_dir", "survey_dir", "class_dir", "out"),
        "combine": ("slots", "participants", "out"),
        "explore": ("participant_dir", "survey_dir", "class_dir", "out"),
        "prepare": ("fused", "train_out", "test_out"),
    }
    for name, paths in positional.items():
        stage = stages.add_parser(name)
        if name in ("fuse", "prepare"):
            stage.add_argument("leading_project", nargs="?", help="the same as --project")
        for path in paths:
            stage.add_argument(path)
        if name == "prepare":
            stage.add_argument("--train-share", type=int, default=80)
            stage.add_argument("--impute-on-train", action="store_true")
    stage = stages.add_parser("train")
    for name in ("train-data", "test-data", "model-output-dir", "metric-output-dir"):
        stage.add_argument(f"--{name}", required=True)
    stage.add_argument("--iterations", type=int, default=300)
    stage.add_argument("--learning-rate", type=float, default=0.01)
    stage.add_argument("--depth", type=int, default=4)
    stage.add_argument("--l2-leaf-reg", type=float, default=3.0)
    stage.add_argument("--keep-identifiers", action="store_true")
    stage.add_argument("--fit-dir", help="folder in which a lost run can be taken up")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    arguments = vars(_arguments(argv))
    stage, project = arguments.pop("stage"), arguments.pop("project")
    project = arguments.pop("leading_project", None) or project
    extra = {"spark.hadoop.fs.gs.project.id": project} if project else {}
    spark = build_session(f"slotfuse-{stage}", extra=extra)
    STAGES[stage](spark, **arguments)


if __name__ == "__main__":
    main()

"""The training-data pipeline: documents through five stages to the mix.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns a DataFrame; `run` writes it to the shared folder and reads it back for the next.

All stages but the last return the columns of `docs` as they are, whatever their names: only
doc_id, text, lang, source and n_chars are read, and only text and n_chars change. Rows
without id, repeated rows and empty tables are handled as the operators say; rows without
text do not pass the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse.llm import decontaminate, mixing, quality, secrets, simhash
from slotfuse.llm.common import read_table, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


CORE = ("doc_id", "text", "lang", "source", "n_chars")


def apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """`work` on `docs` with all other columns out of its way, under names that clash with none.

    The columns come back under their own names, with those that `work` has `added`, which
    replace ones of the same name.
    """
    inner = {c if c in CORE else f"own_{i}": c for i, c in enumerate(docs.columns)}
    done = work(docs.toDF(*inner))
    return done.select(*[F.col(i).alias(c) for i, c in inner.items() if c not in added], *added)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    labels = read_table(spark, sf_dir, "labels")
    return apart(docs, lambda rows: quality.quality_rules(rows, labels).where("kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates."""
    return apart(docs, lambda rows: simhash.drop_near_duplicates(rows, shingle=4, radius=4))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return apart(docs, lambda rows: decontaminate.decontaminate(rows, benchmark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; n_chars follows where a text has changed."""
    def redacted(rows: DataFrame) -> DataFrame:
        clean = secrets.redact(secrets.scan_secrets(rows.withColumn("whole_text", F.col("text"))))
        changed = ~F.col("text").eqNullSafe(F.col("whole_text"))
        return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))

    return apart(docs, redacted)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, `epoch` counting its copies."""
    def mixed(rows: DataFrame) -> DataFrame:
        taken = mixing.mix_sources(rows, keep=rows.columns).where("copies > 0")
        return taken.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    return apart(docs, mixed, "epoch")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("simhash_dedup", drop_copies),
    ("decontaminate", drop_leaks),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix),
]

# Fingerprints, the latent space and hashed n-grams are beyond SQL; the tests compare the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

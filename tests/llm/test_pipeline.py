"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import brute
import pytest
from pyspark.sql import functions as F
from test_quality_method import plain_judgement

import corpus_pipeline
from slotfuse.llm import decontaminate
from slotfuse.llm.decontaminate import bit_places, common_subsequence
from slotfuse.llm.latent import plain_words
from slotfuse.llm.quality import Limits

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    """The table with repeated rows, a missing id, missing texts and columns named as helpers are."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.where("doc_id in (3, 5)").unionByName(docs.where("doc_id in (7, 8)").withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.unionByName(docs.where("doc_id = 9").withColumns({"doc_id": F.lit(90_000).cast("long"), "text": F.lit(None).cast("string")}))
    extra = {c: F.lit(c) for c in ("kept", "score", "spans", "copies", "key", "fingerprint", "component_id", "size", "leaks")}
    return docs.unionByName(odd).withColumns(extra)


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """What went into each stage and what came out."""
    out, docs = {}, documents
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        made.write.parquet(f"{folder}/{name}")
        out[name] = docs, spark.read.parquet(f"{folder}/{name}")
        docs = out[name][1]
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(documents, stages):
    for name, (_, after) in stages.items():
        assert after.columns == [*documents.columns, *(["epoch"] if name == "mix_sources" else [])]


def test_quality_stage(spark, stages):
    before, after = stages["quality_rules"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality is not null").collect()}
    docs = rows(before)
    want = [d for d, (_, kept) in zip(docs, plain_judgement(docs, labels, Limits())) if kept]
    assert sorted(rows(after), key=repr) == sorted(want, key=repr)


def test_near_duplicate_stage(stages):
    before, after = stages["simhash_dedup"]
    docs = rows(before)
    classes = brute.components([(d, brute.simhash(t)) for d, t in docs])
    kept = rows(after)
    with_id = [d for d, _ in kept if d is not None]
    assert sorted(with_id) == sorted({c for c in classes if c is not None})
    assert len(kept) == len({c for c in classes if c is not None}) + len({t for (d, t), c in zip(docs, classes) if c is None})


def test_decontamination_stage(spark, stages):
    before, after = stages["decontaminate"]
    items = [plain_words(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = {d for d, _ in rows(after)}
    for doc, text in rows(before):
        words = plain_words(text)
        joined = b" " + b" ".join(words) + b" "
        if any(b" " + b" ".join(i) + b" " in joined for i in items):
            assert doc not in kept
        elif doc not in kept:  # a paraphrase then: most of an item stands close together
            shares = [
                common_subsequence(bit_places(i), len(i), words[a:a + len(i) * 2]) / len(i)
                for i in items for a in range(0, max(1, len(words)), max(1, len(i) // 2))
            ]
            assert max(shares) >= 0.55
    assert len(kept) >= 0.9 * before.count()


def test_secret_stage(stages):
    before, after = stages["secret_scan"]
    texts = dict(rows(before))
    for doc, text in rows(after):
        assert brute.secret_base(text)[1:3] == (0, 0)
        if brute.secret_base(texts[doc])[:3] == (0, 0, 0) and "-----BEGIN" not in texts[doc]:
            assert len(text) >= 0.5 * len(texts[doc])
    assert after.where("n_chars != length(text)").count() <= before.where("n_chars != length(text)").count()


def test_mixing_stage(stages):
    before, after = stages["mix_sources"]
    size = F.size(F.expr("regexp_extract_all(coalesce(text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"))
    have = {r["source"]: r["n"] for r in before.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    most = before.agg(F.max(size)).first()[0]
    order = sorted(have, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(have.values())
    while free:
        level = left / sum(weight[s] for s in free)
        clamped = {s for s in free if weight[s] * level > 3 * have[s]}
        if not clamped:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: 3 * have[s] for s in clamped})
        left -= sum(3 * have[s] for s in clamped)
        free -= clamped
    taken = {r["source"]: r["n"] for r in after.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    for s in order:
        assert abs(taken.get(s, 0) - target[s]) <= most
    assert after.agg(F.max("epoch")).first()[0] <= 3


def test_decontamination_learns_from_every_row(spark, tmp_path, monkeypatch):
    """The stage's space is fitted on all rows it gets, not on some of them."""
    seen = []
    plain = decontaminate.randomised_svd
    monkeypatch.setattr(decontaminate, "randomised_svd", lambda docs, *a, **k: (seen.append(docs.count()), plain(docs, *a, **k))[1])
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'a' as source", "8L as n_chars")
    leak = docs.limit(1).withColumn("text", F.lit("x one two three four five six seven eight nine ten y"))
    kept = corpus_pipeline.drop_leaks(spark, docs.unionByName(leak), str(tmp_path))
    assert kept.count() == 5000
    assert seen == [5001]

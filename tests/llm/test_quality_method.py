"""The ratio, the threshold and the verdict of the quality rules against plain Python."""

import random
import struct

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from slotfuse.llm import quality
from slotfuse.llm.quality import Limits, quality_rules

LABELS = "doc_id bigint, quality int, toxic int"


def hashed(*values):
    """Spark's xxhash64 of texts and longs, unsigned."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<Q", v % (1 << 64)), seed=seed)
    return seed


def signed_mod(h, n):
    return (h - (1 << 64) if h >> 63 else h) % n


def grams(text):
    words = [hashed(w) for w in brute.WORD.findall(text or "")]
    return words + [hashed(a, b) for a, b in zip(words, words[1:])]


def plain_judgement(docs, labels, limits):
    """{position: (score, kept)} for (doc_id, text) rows and {doc_id: quality}."""
    part = {d: signed_mod(hashed(d, "quality part"), limits.parts) for d in labels}
    good, raw = {}, {}
    for d, text in docs:
        for g in grams(text):
            b = signed_mod(g, limits.buckets)
            raw[b] = raw.get(b, 0) + 1
            if labels.get(d) == 1 and part[d]:
                good[b] = good.get(b, 0) + 1
    n_good, n_raw = sum(good.values()), sum(raw.values())
    ratio = {
        b: round(1000 * float(np.log((good.get(b, 0) + limits.backoff * n_good * n / n_raw) / (n_good * (1 + limits.backoff)) / (n / n_raw)))) if n_good else 0
        for b, n in raw.items()
    }
    score = [sum(ratio[signed_mod(g, limits.buckets)] for g in grams(t)) / (1000 * len(grams(t))) if grams(t) else 0.0 for _, t in docs]
    failed = [brute.quality_base(t)[5] for _, t in docs]
    limit = None
    for held in (lambda d: part[d] == 0, lambda d: True):
        if limit is None:
            sides = [[round(s, 3) for (d, _), s, f in zip(docs, score, failed) if labels.get(d) == q and held(d) and not f] for q in (1, 0)]
            if sides[0]:
                limit = np.quantile(sides[0], limits.most_lost)
                if sides[1]:
                    limit = min(limit, (limit + np.quantile(sides[1], 1 - limits.most_lost)) / 2)
    return [(s, not f and (limit is None or s >= limit)) for s, f in zip(score, failed)]


def texts(rng, n):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    good = [" ".join(rng.choices(words, weights, k=rng.randint(15, 90))) for _ in range(n)]
    salad = ["".join(rng.sample(w, len(w))) + rng.choice(["", "!!", "###"]) for w in words]
    bad = [" ".join(rng.choices(salad, k=rng.randint(15, 90))) for _ in range(n // 3)]
    return good, bad


@pytest.mark.parametrize("labelled", [True, False])
def test_scores_and_verdicts(spark, labelled):
    rng = random.Random(4)
    good, bad = texts(rng, 90)
    docs = [*enumerate([*good, *bad, None, "", "one two"])]
    docs += [(0, docs[0][1]), (None, docs[1][1]), (5000, docs[2][1] + " " + docs[3][1])]
    labels = {i: int(i < 90) for i in range(120) if i % 3} if labelled else {}
    limits = Limits(buckets=1 << 12)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"score": F.lit("x"), "own": F.lit(1), "m": F.lit(2)})
    rows = [(d, q, 0) for d, q in labels.items()] + [(None, 1, 0), (3, None, 0), (99_999, 1, 0)]
    got = quality_rules(df, spark.createDataFrame(rows, LABELS) if labelled else spark.createDataFrame([], LABELS), limits, ["doc_id", "text", "own"])
    assert got.columns == ["doc_id", "text", "own", *quality.ADDED]
    want = sorted(((d, t, round(s, 9), k) for (d, t), (s, k) in zip(docs, plain_judgement(docs, labels, limits))), key=repr)
    assert sorted(((r["doc_id"], r["text"], round(r["score"], 9), r["kept"]) for r in got.collect()), key=repr) == want


def test_letter_salad_scores_below_good_text(spark):
    rng = random.Random(9)
    good, _ = texts(rng, 120)
    salad = [" ".join("".join(rng.sample(w, len(w))) for w in t.split()) for t in good[:20]]  # the same word lengths
    docs = spark.createDataFrame(list(enumerate([*good, *salad])), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)
    score = {r["doc_id"]: r["score"] for r in quality_rules(docs, labels, keep=["doc_id"]).collect()}
    assert all(score[120 + i] < score[i] - 0.5 for i in range(20))
    assert max(score[120 + i] for i in range(20)) < min(score[i] for i in range(60, 120))


def test_more_labels_than_are_learnt_from(spark):
    rng = random.Random(3)
    good, bad = texts(rng, 60)
    docs = spark.createDataFrame(list(enumerate([*good, *bad])), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(80)], LABELS)
    marks = quality.learning_labels(labels, Limits(most_labels=20))
    assert 5 <= marks.count() <= 40
    assert quality_rules(docs, labels, Limits(most_labels=20)).count() == 80


def test_all_labels_are_learnt_from_however_many(spark):
    assert Limits().most_labels is None
    rng = random.Random(6)
    good, bad = texts(rng, 90)
    docs = [*enumerate([*good, *bad, None, ""]), (0, good[0]), (None, good[1]), (None, None)]
    labels = {i: int(i < 90) for i in range(120) if i % 3}
    limits = Limits(buckets=1 << 12)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame([(d, q, 0) for d, q in labels.items()] + [(None, 1, 0)], LABELS)
    want = sorted(((d, t, round(s, 9), k) for (d, t), (s, k) in zip(docs, plain_judgement(docs, labels, limits))), key=repr)
    got = quality_rules(df, marks, limits, max_broadcast_bytes=0)  # as with more labels than may be broadcast
    assert sorted(((r["doc_id"], r["text"], round(r["score"], 9), r["kept"]) for r in got.collect()), key=repr) == want
    # Nothing is thinned beyond the number at which the labels were cut before.
    many = spark.range(450_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert quality.learning_labels(many, Limits()).count() == 450_000

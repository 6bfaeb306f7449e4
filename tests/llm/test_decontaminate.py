"""Decontamination: planted items, paraphrases, false hits, the SVD and the common subsequence."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotfuse.llm import decontaminate
from slotfuse.llm.decontaminate import Search, bit_places, common_subsequence, find_leaks, leaks_of_rows
from slotfuse.llm.latent import _add_cross, corpus_product, passage_rows, plain_words, randomised_svd, word_ids

DOCS = "doc_id bigint, text string"
BENCH = "item_id bigint, text string"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    weights = [1 / (i + 5) for i in range(3000)]
    return lambda n: " ".join(rng.choices(words, weights, k=n))


def test_leaks(spark, prose):
    items = [(i, prose(n)) for i, n in enumerate([15, 59, *range(16, 44)])] + [(98, None), (99, ""), (None, prose(30)), (1, prose(25))]
    texts = [
        prose(300), prose(200) + " " + items[0][1] + " " + prose(100), items[1][1].upper() + "!", None, "", "a b",
        prose(20) + " " + items[32][1], items[33][1] + " " + prose(5), prose(40_000) + " " + items[5][1] + " " + prose(9),
    ]
    rows = [*enumerate(texts), (2, texts[2]), (None, texts[2])]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("key", "share", "leaks", "item_id")})
    bench = spark.createDataFrame(items, BENCH).withColumn("doc_id", F.lit(3))
    want = sorted([(1, 0), (2, 1), (2, 1), (None, 1), (6, None), (7, 1), (8, 5)], key=repr)
    for size in (2048, 11):
        live = []
        plain = spark.sparkContext.broadcast

        def counted(value):
            made = plain(value)
            if isinstance(value, decontaminate.Items):
                assert not any(live)  # one block's vectors at a time
                live.append(True)
                destroy = made.destroy
                made.destroy = lambda *a: (live.__setitem__(-1, False), destroy(*a))[1]
            return made

        spark.sparkContext.broadcast = counted
        try:
            got = leaks_of_rows(docs, bench, ("doc_id", "share"), Search(block_items=size, sample_parts=2))
        finally:
            del spark.sparkContext.broadcast
        assert len(live) == (1 if size == 2048 else 3)
        assert got.columns == ["doc_id", "item_id", "start", "end", "cosine", "share", "answer"]
        assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=repr) == want
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 5]
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert find_leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("replaced", [0.2, 0.3])
def test_paraphrases_are_found_and_others_are_not(spark, prose, replaced):
    rng = random.Random(int(replaced * 10))
    items = [(i, prose(rng.randint(16, 59))) for i in range(60)]
    docs = [(1000 + i, prose(rng.randint(20, 400))) for i in range(400)]
    for i, text in items:
        words = text.split()
        for j in rng.sample(range(len(words)), round(replaced * len(words))):
            words[j] = prose(1)
        host = prose(rng.randint(0, 300)).split()
        at = rng.randint(0, len(host))
        docs.append((i, " ".join(host[:at] + words + host[at:])))
    found = {(r["doc_id"], r["item_id"]) for r in leaks_of_rows(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()}
    assert sum((i, i) in found for i, _ in items) >= 0.9 * len(items)
    assert not {f for f in found if f[0] != f[1]}


def test_short_items_need_all_of_their_words(spark, prose):
    bench = spark.createDataFrame([(1, "one two three four"), (2, "seven")], BENCH)
    docs = spark.createDataFrame([(1, prose(50) + " one two three four " + prose(50)), (2, "one two three " + prose(9)), (3, "six seven")], DOCS)
    got = {(r["doc_id"], r["item_id"]) for r in leaks_of_rows(docs, bench, search=Search(cosine=0.2)).collect()}
    assert got == {(1, 1), (3, 2)}


def test_svd_equals_numpy(spark):
    rng = random.Random(2)
    vocabulary = {bytes([97 + i]): i for i in range(12)}
    texts = [" ".join(chr(97 + rng.choice([i % 4, rng.randrange(13)])) for _ in range(60)) for i in range(40)]
    items = [word_ids(plain_words(t[:40]), vocabulary) for t in texts[:5]]
    idf = np.linspace(0.5, 2, 12)
    sample = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    values, vectors = randomised_svd(sample, items, vocabulary, idf, 12, 20, rounds=3, item_weight=4.0)
    rows = []
    for some, weight in ((items, 2.0), ([r for t in texts for r in passage_rows(word_ids(plain_words(t), vocabulary), 20)], 1.0)):
        for ids in some:
            row = np.bincount(ids[ids < 12], minlength=12) * idf
            rows.append(weight * row / np.linalg.norm(row))
    _, s, v = np.linalg.svd(np.array(rows), full_matrices=False)
    assert values == pytest.approx(s, rel=1e-6)
    assert np.abs(np.sum(vectors * v.T, axis=0)) == pytest.approx(np.ones(12), abs=1e-5)
    few, cut = randomised_svd(sample, items, vocabulary, idf, 4, 20, rounds=8, item_weight=4.0)
    assert few == pytest.approx(s[:4], rel=1e-2) and cut.shape == (12, 4)
    out = np.zeros((12, 2))
    _add_cross(out, [np.array([12, 12])], idf, np.ones((12, 2)))
    assert not out.any()


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice(b"abcde") for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert common_subsequence(bit_places(a), len(a), b) == plain_subsequence(a, b)


def test_document_frequencies(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "B! c"), (3, None), (4, ""), (5, "b b")], DOCS)
    assert decontaminate.document_frequencies(docs, {b"a": 0, b"b": 1, b"zz": 2}).tolist() == [1, 3, 0]


def test_svd_covers_every_document(spark, prose):
    """The products are over all passages, however the texts are dealt over tasks."""
    texts = [prose(n) for n in (0, 1, 47, 48, 49, 130, 9000)] + [prose(60) for _ in range(200)] + [None, ""]
    vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts[:100] for w in plain_words(t)}))}
    rng = np.random.default_rng(1)
    idf, q = rng.uniform(0.5, 3, len(vocabulary)), rng.standard_normal((len(vocabulary), 5))
    want = np.zeros_like(q)
    for t in texts:
        _add_cross(want, passage_rows(word_ids(plain_words(t or ""), vocabulary), 48), idf, q)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [corpus_product(docs.repartition(n), vocabulary, idf, q, 48, 3) for n in (2, 7)]
    assert got[0] == pytest.approx(want, abs=1e-4) and got[1] == pytest.approx(want, abs=1e-4)
    assert not corpus_product(docs.limit(0), vocabulary, idf, q, 48, 3).any()
    strange = spark.createDataFrame([("ÿ þ",), ("",)], "text string")
    assert not corpus_product(strange, vocabulary, idf, q.astype(np.float32), 48, 3).any()


def test_svd_is_not_fitted_on_a_sample(spark, prose, monkeypatch):
    seen = []
    plain = decontaminate.randomised_svd
    monkeypatch.setattr(decontaminate, "randomised_svd", lambda docs, *a, **k: (seen.append(docs.count()), plain(docs, *a, **k))[1])
    docs = spark.createDataFrame([(i, prose(4)) for i in range(9000)], DOCS)
    assert find_leaks(docs, spark.createDataFrame([(1, prose(30))], BENCH)).count() == 0
    assert seen == [9000]

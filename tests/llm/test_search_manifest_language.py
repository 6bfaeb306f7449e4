"""Ranked search, Merkle manifest and language identification against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from slotfuse.llm import language, lexical, manifest
from slotfuse.llm.pieces import Trie, expected_counts, load_pieces, log_likelihoods
from slotfuse.llm.queries import QUERIES

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain_ranks(docs, items, top=10):
    cut = [(d, Counter(plain_terms(t))) for d, t in docs]
    cut = [(d, c) for d, c in cut if c]
    n_docs, n_terms = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in cut:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            s = 0
            for t in set(plain_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if n else d, -s) for i, (s, n, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def search_tables(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé0", k=rng.randint(1, 5))) for _ in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    prose = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, prose(rng.randint(1, 300))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,- \n"), (303, docs[0][1]), (303, docs[0][1]), (None, docs[0][1]), (None, "a b")]
    docs += [(304, prose(60_000)), (305, docs[7][1].upper() + "!"), (-5, docs[7][1])]
    items = [(i, prose(rng.randint(1, 40))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "zzzz notthere"), (1, items[1][1]), (None, "a"), (93, docs[0][1])]
    frames = [spark.createDataFrame(rows, f"{key} bigint, text string") for rows, key in ((docs, "doc_id"), (items, "item_id"))]
    return docs, items, *frames


def test_search_equals_all_scores(search_tables, monkeypatch):
    docs, items, docs_df, items_df = search_tables
    want = plain_ranks(docs, items)
    clash = docs_df.withColumns({c: F.lit(0) for c in ("rank", "score", "item_id", "row", "n")})
    got = lexical.rank_documents(clash.repartition(3), items_df.withColumn("doc_id", F.lit(9)))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    got = lexical.rank_documents(docs_df, items_df, most_terms=60)  # many blocks
    assert sorted(map(tuple, got.collect()), key=repr) == want


@pytest.mark.parametrize("share", [1, 8, 10**9])
def test_short_and_long_lists_give_the_same(share, monkeypatch):
    rng = np.random.default_rng(share % 97)
    monkeypatch.setattr(lexical, "SHORT_SHARE", share)
    size, terms = 500, 40
    held = rng.random((size, terms)) < np.linspace(0.01, 0.9, terms)
    tfs = rng.integers(1, 9, (size, terms))
    weights = rng.integers(0, 5000, terms)
    damping = rng.integers(10, 400, size)
    doc, term = np.nonzero(held)
    step = lexical.Step(held.sum(axis=1), term, tfs[doc, term], damping, weights)
    for least in (1, 10**8, 3 * 10**8, 10**12):
        asked = np.sort(rng.choice(terms, 12, replace=False))
        entry = weights * (1_000_000_000 * tfs // (1000 * tfs + 8 * damping[:, None])) * held
        full = entry[:, asked].sum(axis=1)
        docs, scores = step.search(asked, least)
        assert dict(zip(docs.tolist(), scores.tolist())) == {i: int(s) for i, s in enumerate(full) if s >= least}


def test_long_lists_are_skipped():
    size = 4000
    ids = np.concatenate([np.zeros(size, np.int64), [1]])
    owner = np.concatenate([np.arange(size), [17]])
    order = np.argsort(owner, kind="stable")
    lengths = np.bincount(owner, minlength=size)
    step = lexical.Step(lengths, ids[order], np.ones(len(ids), np.int64), np.full(size, 100), np.array([5, 9000]))
    docs, scores = step.search(np.array([0, 1]), 9000 * (10**9 // 1800))
    assert docs.tolist() == [17] and scores[0] == 9005 * (10**9 // 1800)


def test_search_of_empty_tables(search_tables):
    _, _, docs, items = search_tables
    assert lexical.rank_documents(docs.limit(0), items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0
    assert lexical.rank_documents(docs.where("text is null"), items).count() == 0


# Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    framed = [f"{len(str(v).encode())}:{v}" if v is not None else "-" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*framed)


def plain_climb(nodes):
    """The root, and for each node its siblings as (left, right) from below."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places):
            run = at // 8 * 8
            path.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
        nodes = [digest(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        places = [p // 8 for p in places]
    return nodes[0], paths


def plain_manifest(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = plain_climb([x[2] for x in by_lang[lang]])
    root, tops = plain_climb([trees[v][0] for v in langs])
    out = []
    for lang, top in zip(langs, tops):
        for (_, _, leaf, r), path in zip(by_lang[lang], trees[lang][1]):
            whole = path + top
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = plain_leaf(*r[:4], r[4].translate(SMALL))
            for left, right in whole:
                node = digest(left, node, right)
            out.append((r[0], leaf, trees[lang][0], root, digest(*[a + b for a, b in whole]), node, node == root))
    return sorted(out, key=repr)


def manifest_rows(n, seed=0):
    rng = random.Random(seed)
    rows = [(i, f"s{i % 3}", rng.choice(["en"] * 5 + ["de", "é", "z", None]), rng.randint(0, 9), rng.choice(["Ab c", "x", "", None, "É É"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [1, 9, 200])
def test_manifest_equals_plain_trees(spark, n):
    rows = manifest_rows(n, n)
    if n == 200:
        rows += [(None, None, None, None, None), (None, "s", "en", None, "Q"), rows[0], rows[0], rows[1], (7, "other", "en", 1, "A" * 300_000)]
        rows += [(1000 + i, None, f"lang{i}", None, None) for i in range(12)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("tree", "rank", "digest", "n", "root", "path")})
    got = manifest.verify_rows(df.repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)


def test_manifest_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert manifest.verify_rows(empty).count() == 0
    assert manifest.build_manifest(empty).store().count() == 0


def test_some_requests_and_a_store_without_strays(spark):
    rows = [(i, "s", "en" if i < 70 else "de", 1, f"text {i}") for i in range(90)]
    made = manifest.build_manifest(spark.createDataFrame(rows, DOCS))
    asked = spark.createDataFrame([("=en", 69, "a"), ("=en", 69, "b"), ("=en", 70, "no such leaf"), ("=de", 0, "c")], "tree string, rank bigint, why string")
    proven = {r["why"]: r for r in manifest.prove(made, asked).collect()}
    assert set(proven) == {"a", "b", "c"}
    assert proven["a"]["leaf"] == plain_leaf(*rows[69]) and proven["c"]["leaf"] == plain_leaf(*rows[70])
    for r in proven.values():
        node = r["leaf"]
        for left, right in r["path"]:
            node = digest(left, node, right)
        assert node == r["root"]
    stored = {r["digest"]: r["children"] for r in made.store().collect()}
    assert all(digest(*children) == key for key, children in stored.items())
    todo, leaves = [made.root.first()["digest"]], []
    while todo:
        node = todo.pop()
        if node in stored:
            todo += stored[node]
        else:
            leaves.append(node)
    assert sorted(leaves) == sorted(plain_leaf(*r) for r in rows)


# Language identification


def all_segmentations(word, pieces, chance):
    if not word:
        return 1.0
    return sum(chance[p] * all_segmentations(word[len(p):], pieces, chance) for p in pieces if word.startswith(p))


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca", b"cab"]
    trie = Trie(pieces)
    chances = rng.random((len(pieces), 3))
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 14))).encode() for _ in range(50)]
    logs = log_likelihoods(trie, words, chances)
    for word, row in zip(words, logs):
        for lang in range(3):
            want = all_segmentations(word, pieces, dict(zip(pieces, chances[:, lang])))
            assert row[lang] == pytest.approx(math.log(want), rel=1e-9)


def test_long_words_do_not_underflow():
    trie = Trie([b"a", b"aa", b"b"])
    got = log_likelihoods(trie, [b"b" * 20_000, b"a"], np.array([[0.1], [0.2], [1e-6]]))
    assert got[0, 0] == pytest.approx(20_000 * math.log(1e-6)) and got[1, 0] == pytest.approx(math.log(0.1))


def segmentations(word, pieces):
    if not word:
        yield ()
    for p in pieces:
        if word.startswith(p):
            for rest in segmentations(word[len(p):], pieces):
                yield (p, *rest)


def test_expected_counts():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba"]
    chance = dict(zip(pieces, (0.3, 0.2, 0.1, 0.25, 0.15)))
    want = Counter()
    for word, n in ((b"ababa", 3), (b"bb", 1), (b"abab", 2)):
        each = [(s, math.prod(chance[p] for p in s)) for s in segmentations(word, pieces)]
        total = sum(w for _, w in each)
        for s, w in each:
            for p in s:
                want[p] += n * w / total
    got = expected_counts(Trie(pieces), [b"ababa", b"bb", b"abab"], np.array([3.0, 1, 2]), np.array(list(chance.values())))
    assert got == pytest.approx([want[p] for p in pieces])


def test_pieces_cover_every_text():
    pieces = load_pieces(VOCABULARY)
    assert {bytes([b]) for b in range(256)} <= set(pieces) and b" the" in pieces and len(set(pieces)) == len(pieces)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op13_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    right = {r[0]: r[1] for r in got.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()}
    assert right[True] >= 0.99 and right[False] >= 0.99


def test_languages_of_hard_rows(spark):
    said = {"en": "the house and the garden", "de": "das haus und der garten", None: "la maison"}
    rows = [(i, text, lang) for i, (lang, text) in enumerate(list(said.items()) * 9)]
    hard = [None, "", "123 !? “—” ²", "the house", "The HOUSE!", "haus" * 20_000, "und " * 300_000, "日本語", "der garten", "der garten"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(docs, VOCABULARY)
    assert model.languages == ["de", "en"]
    assert model.chances.sum(axis=0) == pytest.approx([1, 1])
    asked = spark.createDataFrame(list(enumerate(hard)), "doc_id bigint, text string").withColumns({"lang_pred": F.lit(1), "score": F.lit(2)})
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(asked, model).collect()}
    assert [got[i][0] for i in range(7)] == ["und", "und", "und", "en", "en", "de", "de"]
    assert got[0][1] == 0 and got[3] == got[4] and got[8] == got[9] and all(0 <= s <= 1 for _, s in got.values())
    none = language.identify(docs.where("lang is null"), VOCABULARY).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == 9
    assert language.identify(docs.limit(0), VOCABULARY).count() == 0
    ids = spark.createDataFrame([(i, "x", "en") for i in (None, *range(50))], "doc_id bigint, text string, lang string")
    out = {r["doc_id"]: r["held_out"] for r in language.identify(ids, VOCABULARY).collect()}
    assert out.pop(None) is False and out == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}

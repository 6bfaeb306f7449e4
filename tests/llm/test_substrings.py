"""Chunks against a plain count of the digests in all texts."""

import random

from pyspark.sql import functions as F

from slotfuse.llm.substrings import PASSAGE, chunk_ends, drop_spans, find_repeats, without_repeats

ROWS = "doc_id bigint, text string"


def prose(rng, n, letters="abcdefé"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


def test_repeats(spark):
    rng = random.Random(2)
    shared = prose(rng, 120)
    texts = [prose(rng, 200) + shared + prose(rng, 50), "x" + prose(rng, 77) + shared, prose(rng, 300), None, "", "a" * 3000, "short"]
    rows = [*enumerate(texts), (2, texts[2]), (9, "short")]
    docs = spark.createDataFrame(rows, ROWS)
    got = find_repeats(docs).collect()
    seen, want = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        data, last, spans = (text or "").encode(), 0, []
        for end in chunk_ends(data) if data else []:
            if data[last:end] in seen:
                if spans and spans[-1][1] == last:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((last, end))
            seen.add(data[last:end])
            last = end
        want.append((key, spans, sum(s[1] - s[0] >= PASSAGE or s == (0, len(data)) for s in spans)))
    assert sorted((r["doc_id"], [tuple(x) for x in r["repeats"]], r["n_repeats"]) for r in got) == sorted(want)
    assert all(r["n_spans"] == len(r["repeats"]) >= r["n_repeats"] and r["repeat_bytes"] == sum(b - a for a, b in r["repeats"]) for r in got)
    assert next(r for r in got if r["doc_id"] == 1)["repeat_bytes"] > 0.5 * len(shared)
    assert next(r for r in got if r["doc_id"] == 9)["repeat_bytes"] == len("short")
    assert find_repeats(docs.where("doc_id > 99")).count() == 0


def test_passages_are_found_and_chance_phrases_are_not(spark):
    """Passages of 51 words at any place, among texts over one small vocabulary."""
    rng = random.Random(4)
    vocabulary = prose(rng, 400).split()
    said = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passages = [said(51) for _ in range(150)]
    first = [f"{said(rng.randint(20, 90))} {p} {said(40)}" for p in passages]
    again = [f"{said(rng.randint(20, 90))} {p} {said(40)}" for p in passages]
    clean = [said(150) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate([*clean, *first, *again])), ROWS)
    caught = {r["doc_id"] for r in find_repeats(docs).where("n_repeats > 0").collect()}
    assert len(caught & set(range(300, 450))) >= 147 and not caught & set(range(300))


def test_short_repeats_are_returned_too(spark):
    rng = random.Random(8)
    shared = [prose(rng, 9) for _ in range(60)]
    docs = [(i, f"{prose(rng, 30)} {s} {prose(rng, 30)}") for i, s in enumerate(shared * 2)]
    got = {r["doc_id"]: r for r in find_repeats(spark.createDataFrame(docs, ROWS)).collect()}
    short = [r for r in got.values() if r["n_spans"] and not r["n_repeats"]]
    assert len(short) > 10 and all(r["repeat_bytes"] > 0 for r in short)


def test_texts_without_their_repeats(spark):
    rng = random.Random(3)
    shared = prose(rng, 150, "abcdé日")
    rows = [(1, f"{prose(rng, 40)} {shared}", "x"), (2, f"é{prose(rng, 41)} {shared} {prose(rng, 20)}", "y"), (3, None, "z"), (4, "", None), (4, "all of it", "a"), (4, "all of it", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, repeats string").withColumn("uid", F.lit(5))
    got = without_repeats(docs)
    assert got.columns == docs.columns
    out = sorted(((r["doc_id"], r["text"], r["repeats"], r["uid"]) for r in got.collect()), key=repr)
    texts = {i: t for i, t, _, _ in out if i < 4}
    assert texts[1] == rows[0][1] and texts[3] is None and len(texts[2]) < len(rows[1][1]) - 0.5 * len(shared)
    assert sorted(t for i, t, _, _ in out if i == 4) == ["", "", "all of it"] and {u for *_, u in out} == {5}
    assert texts[2][:20] == rows[1][1][:20] and texts[2][-20:] == rows[1][1][-20:]
    assert drop_spans("ééé", [(1, 3)], 1) == "ééé" and drop_spans("aééb", [(1, 3)], 1) == "aéb" and drop_spans("ab", [(0, 2)], 99) == ""


def test_long_texts_and_ties(spark):
    docs = spark.createDataFrame([(7, "w " * 200_000), (None, "w " * 200_000), (7, "w " * 200_000)], ROWS)
    got = find_repeats(docs.withColumns({c: F.lit(1) for c in ("chunks", "n_chunks", "digest")}), keep=("doc_id", "chunks")).collect()
    assert len(got) == 3 and all(r["chunks"] == 1 for r in got)
    assert sorted(r["repeat_bytes"] for r in got)[1:] == [400_000, 400_000]

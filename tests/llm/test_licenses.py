"""License scan: diagonals, merged spans and labels against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from slotfuse.llm import licenses
from slotfuse.llm.license_texts import TEMPLATES, Template

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(SMALL))


def grams(words, k=3):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def plain_spans(text, templates, k=3, slack=3, gap=40, least_share=0.6):
    out = set()
    mine = grams(plain_words(text))
    for number, template in enumerate(templates):
        theirs = grams(plain_words(template.text))
        places = {}
        for q, g in enumerate(theirs):
            places.setdefault(g, []).append(q)
        diagonals = {}
        for p, g in enumerate(mine):
            for q in places.get(g, ()):
                diagonals.setdefault(p - q, []).append((p, q))
        runs, last = [], None
        for d in sorted(diagonals):
            if last is None or d - last > slack:
                runs.append([])
            runs[-1] += diagonals[d]
            last = d
        runs.sort(key=lambda r: (min(r)[0]))
        chains, end = [], None
        for r in runs:
            low, high = min(p for p, _ in r), max(p for p, _ in r)
            if end is None or low - end > gap + k:
                chains.append([])
            chains[-1] += r
            end = high if end is None else max(end, high)
        needs = set(grams(plain_words(template.needs)))
        for c in chains:
            qs = {q for _, q in c}
            if len(qs) / len(theirs) >= least_share and needs <= {theirs[q] for q in qs}:
                out.add((template.label, number, min(p for p, _ in c), max(p for p, _ in c) + k, round(len(qs) / len(theirs), 9)))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    filler = lambda n: " ".join(rng.choices(["lorem", "of", "the", "license", "this", "software", "x1", "é", "is", "all"], k=n))
    out = [None, "", "all rights", "All rights reserved."]
    for t in TEMPLATES:
        words = t.text.split()
        out.append(f"{filler(30)} {t.text} {filler(20)}")
        for i in rng.sample(range(len(words)), len(words) // 12):
            words[i] = "changed"
        out.append(f"{filler(5)} {' '.join(words)}")
        half = len(words) // 2
        out.append(" ".join(words[:half]) + " " + filler(rng.randint(1, 60)) + " " + " ".join(words[half:]))
    out.append(" ".join(out[-20:]) * 3)
    out += [out[4], out[4], filler(20_000) + " " + TEMPLATES[3].text]
    return out


def test_spans_equal_plain_diagonals(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    clash = df.withColumns({c: F.lit(0) for c in ("key", "template", "p", "q", "label", "n_words", "chain")})
    got = licenses.scan_licenses(clash.repartition(3), keep=("doc_id", "chain")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_spans(texts[r["doc_id"]], TEMPLATES)
        assert {(s["label"], s["start"], s["end"], round(s["share"], 9)) for s in r["spans"]} == {(a, s, e, x) for a, _, s, e, x in want}
        labels = set(filter(None, r["base_labels"].split(","))) | {a for a, *_ in want}
        assert r["labels"] == ",".join(sorted(labels))
        best = max((x for *_, x in want), default=0)
        assert r["score"] == pytest.approx(max(best, 0.5 if r["n_base"] else 0))


def test_parts_of_templates_and_their_like(spark):
    by_label = {}
    for t in TEMPLATES:
        by_label.setdefault(t.label, []).append(t.text)
    rows = [
        ("warranty", next(t for t in by_label["mit"] if "NONINFRINGEMENT" in t)),
        ("spdx", "# SPDX-License-Identifier: Apache-2.0\nimport x"),
        ("lgpl", by_label["lgpl"][0]), ("agpl", by_label["agpl"][0]), ("gpl", by_label["gpl"][1]),
        ("split", by_label["bsd"][4].replace("HOWEVER CAUSED", "SOME MORE WORDS THAT WERE PUT IN HERE BY SOMEBODY AT LENGTH " * 3)),
        ("changed", by_label["mit"][1].replace("free of charge", "entirely free of any charge")),
        ("none", "permission is hereby given to nobody"),
    ]
    got = {r["name"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "name string, text string"), keep=("name",)).collect()}
    assert got["warranty"]["labels"] == "mit" and got["spdx"]["labels"] == "apache"
    assert {r["label"] for r in got["lgpl"]["spans"]} == {"lgpl"}
    assert {r["label"] for r in got["agpl"]["spans"]} == {"agpl"}
    assert {r["label"] for r in got["gpl"]["spans"]} == {"gpl"}
    assert got["split"]["labels"] == "bsd" and got["changed"]["labels"] == "mit" and got["none"]["labels"] == ""


def test_own_templates_and_empty_tables(spark):
    own = [Template("own", "one two three four five six seven"), Template("short", "one two")]
    df = spark.createDataFrame([(1, "one two three four five six seven"), (2, "seven six five")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(df, templates=own).collect()}
    assert got == {1: "own", 2: ""}
    assert licenses.scan_licenses(df.limit(0)).count() == 0

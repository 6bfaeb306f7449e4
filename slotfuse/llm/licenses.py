"""License scans by diagonal voting.

All rolling word k-grams of all texts meet the k-grams of the license templates in one
Spark join on their hash. A hit at word p of the text and word q of the template votes for
the diagonal p - q: a copied passage puts its hits on one diagonal, and an inserted or
dropped word moves the rest to the next one. Votes are counted per diagonal, neighbouring
diagonals are merged, and merged runs of one template that follow each other closely are
one span, so a copy with a longer insertion is not lost. A span is verified by the share of
the template's k-grams in it, and by the words that tell the template from its like.

The templates are few and fixed, so their side is broadcast; texts are never shuffled,
only hits are. Texts are addressed by a 128-bit digest, so a hot group of copies is one
text. Words are cut and hashed by small Arrow functions, everything else is Spark SQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.llm.common import broadcast_if_small, ship_package, staged
from slotfuse.llm.license_texts import PHRASES, TEMPLATES, Template
from slotfuse.llm.lexical import terms

FINDING_BYTES = 256
WORD_CACHE = 1 << 18  # hashes of words that a worker keeps, emptied when it is full
STEP = np.uint64(0x9E3779B97F4A7C15)  # base of the rolling hash
PHRASE_EVIDENCE = 0.5  # what a phrase alone adds to the score

_WORD_HASHES: dict[bytes, int] = {}


def gram_hashes(words: Sequence[bytes], k: int) -> np.ndarray:
    """Rolling hashes of all runs of k words, in order, as signed numbers."""
    if len(words) < k:
        return np.empty(0, np.int64)
    if len(_WORD_HASHES) > WORD_CACHE:
        _WORD_HASHES.clear()
    known = _WORD_HASHES
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    rolled = each[:len(words) - k + 1].copy()
    for i in range(1, k):
        rolled = rolled * STEP + each[i:len(words) - k + 1 + i]
    return rolled.view(np.int64)


def phrase_starts(words: Sequence[bytes], phrase: Sequence[bytes]) -> list[int]:
    """Words, from 0, at which the phrase's words stand consecutively."""
    first, n = phrase[0], len(phrase)
    starts, at = [], -1
    while True:
        try:
            at = words.index(first, at + 1)
        except ValueError:
            return starts
        if words[at:at + n] == phrase:
            starts.append(at)


def _base(texts: pd.Series, phrases: Mapping[str, str]) -> pd.DataFrame:
    wanted = [(terms(p.encode()), p.encode().lower().split()[-1], label) for p, label in phrases.items()]
    rows = []
    for text in texts:
        words, starts, named = terms(text), [], set()
        for phrase, mark, label in wanted:
            if mark in text.lower():
                found = phrase_starts(words, phrase)
                starts += found
                named.update([label] * bool(found))
        rows.append((
            xxhash.xxh3_128_digest(text), len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(named)
        ))
    frame = pd.DataFrame(rows, columns=["key", "n_words", "n_base", "first_word", "last_word", "named"])
    return frame.astype({"first_word": "Int64", "last_word": "Int64"})


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def gram_hits(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, k: int = 3) -> DataFrame:
    """key, template, p, q: every place where a text's k-gram is a template's, once a text.

    The rolling hashes of all texts are joined with those of the templates.
    """
    spark = docs.sparkSession
    ship_package(spark)
    wanted = [
        f"({i}, {q}, {h}L)" for i, t in enumerate(templates) for q, h in enumerate(gram_hashes(terms(t.text.encode()), k).tolist())
    ]
    wanted = spark.sql(f"select * from values {', '.join(wanted)} as t(template, q, gram)")

    @F.pandas_udf("struct<key:binary,grams:array<bigint>>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            grams = pd.Series([gram_hashes(terms(t), k) for t in texts], dtype=object)
            yield pd.DataFrame({"key": [xxhash.xxh3_128_digest(t) for t in texts], "grams": grams})

    cut = docs.where("text is not null").select(hashed(_bytes(F.col("text"))).alias("h"))
    seen = cut.select("h.key", F.posexplode("h.grams").alias("p", "gram"))
    # As long as the templates, never as the data.
    return seen.join(F.broadcast(wanted), "gram").select("key", "template", "p", "q").distinct()


def license_spans(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, k: int = 3, slack: int = 3, gap: int = 40, least_share: float = 0.6
) -> DataFrame:
    """key (digest of the text), label, template, start, end, share: verified spans.

    Diagonals at most `slack` apart are merged, and runs of a template with at most `gap`
    words between them are one span. A span needs `least_share` of the template's k-grams,
    and all k-grams of what the template `needs`. NULL and empty texts have no spans,
    copies of a text share theirs.
    """
    spark = docs.sparkSession
    grams = [gram_hashes(terms(t.text.encode()), k) for t in templates]
    needed = [set(gram_hashes(terms(t.needs.encode()), k).tolist()) for t in templates]
    facts = spark.sql("select * from values " + ", ".join(
        f"({i}, '{t.label}', {len(g)}, array({', '.join(str(q) for q, h in enumerate(g.tolist()) if h in need)})::array<int>)"
        for i, (t, g, need) in enumerate(zip(templates, grams, needed))
    ) + " as t(template, label, n_grams, needs)")

    hits = gram_hits(docs, templates, k).withColumn("diagonal", F.col("p") - F.col("q"))
    mine = Window.partitionBy("key", "template")
    by_diagonal = mine.orderBy("diagonal")
    votes = hits.groupBy("key", "template", "diagonal").agg(
        F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("q").alias("qs")  # as long as the template
    )
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > slack, F.lit(False)).cast("int")
    merged = votes.withColumn("apart", apart)
    merged = merged.withColumn("run", F.sum("apart").over(by_diagonal.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("key", "template", "run")
    merged = merged.withColumns({"run_low": F.min("low").over(run), "run_high": F.max("high").over(run)})
    by_place = mine.orderBy("run_low", "run", "diagonal")
    reached = F.max("run_high").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    far = F.coalesce(F.col("run_low") - reached > gap + k, F.lit(False)).cast("int")
    chained = merged.withColumn("far", far)
    chained = chained.withColumn("chain", F.sum("far").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    each = chained.select("key", "template", "chain", "low", "high", F.explode("qs").alias("q"))
    spans = each.groupBy("key", "template", "chain").agg(
        F.min("low").alias("start"), (F.max("high") + k).alias("end"), F.collect_set("q").alias("qs")
    ).join(F.broadcast(facts), "template")  # one row a template
    share = F.size("qs") / F.col("n_grams")
    whole = F.size(F.array_except("needs", "qs")) == 0
    return spans.where((share >= least_share) & whole).select("key", "label", "template", "start", "end", share.alias("share"))


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, keep: Sequence[str] = ("doc_id",), **how) -> DataFrame:
    """The columns `keep` of every row, with what phrases and spans say about its text.

    n_words; n_base, first_word, last_word, base_labels from the phrases; labels with the
    spans' labels added; spans (array of label, start, end, share); score, the greatest
    share of a template, at least 0.5 where a phrase stands, else 0. NULL and empty texts
    have no words and no labels; texts of any length are read whole. Repeated rows all
    stay, an empty table gives an empty table, other columns are not read, and added columns
    replace ones of the same name.
    """
    ship_package(docs.sparkSession)
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score")
    inner = {c: f"kept_{i}" for i, c in enumerate(c for c in keep if c not in added)}

    @F.pandas_udf("struct<key:binary,n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,named:array<string>>")
    def base(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield _base(texts, phrases)

    spans = license_spans(docs.select("text"), **how).groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "label", "share"))).alias("spans")
    )
    spans = broadcast_if_small(staged(spans, "license-spans"), FINDING_BYTES)
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], base(_bytes(F.col("text"))).alias("b"))
    rows = rows.select(*inner.values(), "b.*").join(spans, "key", "left")
    found = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,label:string,share:double>>"))
    share = F.coalesce(F.array_max(F.transform(found, lambda s: s["share"])), F.lit(0.0))
    named = F.col("named")
    return rows.select(
        *[F.col(n).alias(c) for c, n in inner.items()],
        "n_words", "n_base", "first_word", "last_word",
        F.array_join(named, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(named, F.transform(found, lambda s: s["label"]))), ",").alias("labels"),
        found.alias("spans"),
        F.greatest(share, F.when(F.col("n_base") > 0, PHRASE_EVIDENCE).otherwise(0.0)).alias("score"),
    )

"""Quality rules: simple counts, and a hashed n-gram log-likelihood ratio.

N-grams are words and pairs of neighbouring words, hashed into 2^18 buckets. Two multinomials
over the buckets are counted: one over the trusted target (documents labelled good), one
over the raw corpus (all documents). A document's score is the mean, over its n-grams, of
the log of the ratio of both. The target backs off to the raw corpus: its counts are
raised by `backoff` times as many n-grams spread as in the raw corpus. An n-gram the target
does not know then has the same ratio, below 1, whether it is rare or common, so a rare
word of a clean text weighs as much as any other and not more.

A document is kept if its score reaches a threshold fixed for the whole corpus. One in
`parts` labelled documents, by a hash of its id, is left out of the target and sets it: the
score that all but `most_lost` of its good documents reach, or halfway down to what all
but `most_lost` of its bad ones stay below, if that is less. Nothing is drawn at random.

All labels count, however many: they are broadcast while they are few. Beyond that the
texts that may be in the target are joined to them by merging, and the scores of the
documents left out are, without their texts.

All of it is Spark SQL functions. Texts are read twice, once to count and once to score,
and are not staged, nor shuffled while the labels are few; what is shuffled then is at most
one count a bucket and task.
The ratios are whole thousandths, so sums do not depend on their order. They are a session
variable of 2^18 numbers, which plans hold as a constant, so that a text is scored where
it is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import BLANKS, MAX_BROADCAST_BYTES, let, staged, words

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
SYMBOLS = "#*$%&|<>"
SCALE = 1000  # ratios are kept in thousandths
LABEL_BYTES = 64  # of a label in a broadcast table


@dataclass(frozen=True)
class Limits:
    least_words: int = 20
    most_repeated_percent: int = 30
    window: int = 8
    buckets: int = 1 << 18
    backoff: float = 0.1
    parts: int = 4
    most_lost: float = 0.02
    most_labels: int | None = None  # if given, more labelled documents are thinned by hash to about so many


def pairs_at(array: Column, distance: int) -> Column:
    """One hash for each element and the one `distance` further on."""
    n = F.greatest(F.size(array) - distance, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), n), F.slice(array, F.lit(distance + 1), n), lambda a, b: F.xxhash64(a, b))


def repeated_words(pairs: Column, window: int = 8) -> Column:
    """Words in windows of `window` words that occur twice or more in the text.

    `pairs` are the 64-bit hashes of all pairs of neighbouring words; `window` is a power of
    two. Windows are compared by 64-bit hash. Only if some hash repeats are (hash, place)
    pairs sorted: equal neighbours give the places of repeated windows, and each adds the
    words up to the next one's start, at most `window`.
    """
    def hashes(h: Column) -> Column:
        """Window hashes from pair hashes: two pairs, then two fours, and so on."""
        distance = 2
        while distance < window:
            h, distance = let(h, lambda x, d=distance: pairs_at(x, d)), 2 * distance
        return h

    def covered(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(pairs, a)["h"] == F.get(pairs, b)["h"], F.lit(False))
        hit = F.filter(
            F.transform(pairs, lambda p, i: F.when(same(i, i - 1) | same(i, i + 1), p["i"])), lambda p: p.isNotNull()
        )
        return F.aggregate(
            F.array_sort(hit),
            F.struct(F.lit(-window).alias("at"), F.lit(0).alias("sum")),
            lambda acc, p: F.struct(
                p.alias("at"), (acc["sum"] + F.lit(window) - F.greatest(F.lit(0), acc["at"] + window - p)).alias("sum")
            ),
            lambda acc: acc["sum"],
        )

    def of_hashes(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, covered))

    return let(hashes(pairs), of_hashes).cast("long")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def base_counts(text: Column, grams: Column, window: int = 8) -> dict[str, Column]:
    """The base columns of a text whose words and pairs have the hashes `grams`."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(grams["word"]).cast("long"),
        "word_chars": F.length(without(text, BLANKS)).cast("long"),
        "n_symbols": (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(grams["pair"], window),
    }


def hashed_grams(text: Column) -> Column:
    """A struct of two arrays: hashes of the words, and of the pairs of neighbouring words."""
    each = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(each, lambda h: F.struct(h.alias("word"), pairs_at(h, 1).alias("pair")))


def _bucket(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets).cast("long")).cast("int")


def _part(limits: Limits) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("quality part")), F.lit(limits.parts))


def learning_labels(labels: DataFrame, limits: Limits) -> DataFrame:
    """doc_id, quality: one label a document, all of them unless `most_labels` is given.

    Of contradicting labels the worse counts. Labels without id or quality count for
    nothing. More than `most_labels` are thinned by a hash of the id, at a rate taken from
    their number.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    marks = staged(marks.groupBy("doc_id").agg(F.min("quality").alias("quality")), "quality-labels")
    if limits.most_labels is None:
        return marks
    share = min(1.0, limits.most_labels / max(1, marks.count()))
    return marks.where(F.pmod(F.xxhash64("doc_id", F.lit("quality label")), F.lit(1 << 20)) < int(share * (1 << 20)))


def with_target(docs: DataFrame, marks: DataFrame, limits: Limits, few: bool) -> DataFrame:
    """text, good (1 in the target, else NULL) of all rows with text.

    A `few` labels are broadcast. Else only texts that may be in the target are merged with
    them, not those left out of it or without id.
    """
    learns = _part(limits) != 0
    trusted = marks.where((F.col("quality") == 1) & learns).select("doc_id", F.lit(1).alias("good"))
    texts = docs.select("doc_id", "text").where("text is not null")
    if few:
        return texts.join(F.broadcast(trusted), "doc_id", "left").select("text", "good")
    may = learns & F.col("doc_id").isNotNull()
    merged = texts.where(may).join(trusted.hint("merge"), "doc_id", "left").select("text", "good")
    return merged.unionByName(texts.where(~may).select("text", F.lit(None).cast("int").alias("good")))


def ratios(docs: DataFrame, marks: DataFrame, limits: Limits, few: bool = True) -> DataFrame:
    """One row, `ratios`: by bucket, thousandths of the log of target over raw probability."""
    grams = hashed_grams(F.col("text"))
    each = with_target(docs, marks, limits, few).select(
        "good", F.explode(let(grams, lambda g: F.concat(g["word"], g["pair"]))).alias("gram")
    )
    counts = each.groupBy(_bucket(F.col("gram"), limits.buckets).alias("bucket")).agg(
        F.count("good").alias("good"), F.count(F.lit(1)).alias("raw")
    )
    counts = staged(counts, "quality-counts")
    totals = counts.agg(F.struct(F.sum("good").alias("good"), F.sum("raw").alias("raw")).alias("n"))
    n = totals.scalar()
    spread = F.lit(limits.backoff) * n["good"] * F.col("raw") / n["raw"]
    # Both are divided by the raw probability: ratio = (good + spread) / (all good + backoff) / raw share.
    ratio = (F.col("good") + spread) / (n["good"] * (1 + limits.backoff)) / (F.col("raw") / n["raw"])
    known = counts.select("bucket", F.when(n["good"] > 0, F.round(SCALE * F.ln(ratio))).otherwise(0).cast("int").alias("x"))
    every = docs.sparkSession.range(limits.buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(known, "bucket", "left").select("bucket", F.coalesce("x", F.lit(0)).alias("x"))
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "x")))  # as many as there are buckets
    return full.agg(F.transform(pairs, lambda p: p["x"]).alias("ratios"))


def _score(grams: Column, ratios_of: Column, buckets: int) -> Column:
    """Mean ratio over words and pairs; 0 without words."""
    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda acc, h: acc + F.get(ratios_of, _bucket(h, buckets)))

    n = F.size(grams["word"]) + F.size(grams["pair"])
    mean = (total(grams["word"]) + total(grams["pair"])) / (n * SCALE)
    return F.when(n > 0, mean).otherwise(F.lit(0.0))


def _failed(counts: Column, limits: Limits) -> Column:
    repeated = 100 * counts["n_repeat_words"] > limits.most_repeated_percent * counts["n_words"]
    return (counts["n_words"] < limits.least_words) | repeated


def threshold(judged: DataFrame, limits: Limits) -> float | None:
    """The score to be reached, from scored documents (quality, score) left out of the target.

    NULL scores nothing: without good documents there is no threshold.
    """
    good, bad = (F.when(F.col("quality") == q, F.round("score", 3)) for q in (1, 0))
    lost = limits.most_lost
    row = judged.agg(F.percentile(good, lost).alias("good"), F.percentile(bad, 1 - lost).alias("bad")).first()
    if row["good"] is None or row["bad"] is None:
        return row["good"]
    return min(row["good"], (row["good"] + row["bad"]) / 2)


def quality_rules(
    docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), keep: Sequence[str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The columns `keep` (all) of every row, with the base counts, base_failed, score, kept.

    `labels` has doc_id and quality (1 good, 0 bad); labels of other documents and rows
    without quality count for nothing. A NULL text has no words and fails the base rules.
    Without good labelled documents the base rules alone decide; if all of them teach the
    target, or none does, the threshold is taken over all labelled documents. The score is 0
    without words. Texts of any length are judged whole. Repeated rows are all judged, and
    alike; the added columns replace ones of the same name. An empty table gives an empty
    table.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    inner = {c: f"kept_{i}" for i, c in enumerate(keep)}
    marks = learning_labels(labels, limits)
    few = marks.count() * LABEL_BYTES <= max_broadcast_bytes
    learnt = staged(ratios(docs, marks, limits, few), "quality-ratios")
    # A session variable: a scalar subquery may not stand inside a higher-order function,
    # and a column would be copied into every row.
    name = f"quality_ratios_{uuid.uuid4().hex}"
    view = f"view_{name}"
    learnt.createOrReplaceTempView(view)
    spark.sql(f"declare variable {name} array<int>")
    spark.sql(f"set variable {name} = (select ratios from {view})")
    ratios_of = F.expr(f"session.{name}")

    text = F.col("judged_text")
    rows = docs.select("doc_id", F.col("text").alias("judged_text"), *[F.col(f"`{c}`").alias(n) for c, n in inner.items()])

    def measure(grams: Column) -> Column:
        counts = base_counts(text, grams, limits.window)
        return F.struct(*[c.alias(n) for n, c in counts.items()], _score(grams, ratios_of, limits.buckets).alias("score"))

    measured = let(hashed_grams(text), measure)
    limit = None
    for held in (_part(limits) == 0, F.lit(True)):
        if limit is None:
            # Staged before the filter, which would measure all texts a second time.
            some, texts = marks.where(held), rows.where(held & F.col("doc_id").isNotNull())
            if few:
                found = texts.join(F.broadcast(some), "doc_id").select("quality", measured.alias("m"))
                found = found.select("quality", "m.score", _failed(F.col("m"), limits).alias("base_failed"))
            else:  # measured where they are read, so that no text is moved
                found = texts.select("doc_id", measured.alias("m"))
                found = found.select("doc_id", "m.score", _failed(F.col("m"), limits).alias("base_failed"))
                found = found.join(some.hint("merge"), "doc_id").select("quality", "score", "base_failed")
            limit = threshold(staged(found, "quality-held").where("not base_failed"), limits)
    judged = rows.select(*inner.values(), measured.alias("m")).select(*inner.values(), "m.*", _failed(F.col("m"), limits).alias("base_failed"))
    good = F.lit(True) if limit is None else F.col("score") >= limit
    judged = judged.select(*[F.col(n).alias(c) for c, n in inner.items()], "*", (~F.col("base_failed") & good).alias("kept"))
    spark.catalog.dropTempView(view)
    spark.sql(f"drop temporary variable {name}")
    return judged.select(*keep, *ADDED)

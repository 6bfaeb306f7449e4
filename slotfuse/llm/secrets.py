"""Secret scans with a trigram inverted index.

Each rule is a regular expression. From it a Boolean trigram query is derived
(`trigrams`): alternatives of trigrams that a matching text must contain. The index
holds, for every trigram some query uses, the texts that contain it; a rule's candidates
are the texts whose postings meet all trigrams of one alternative, and only they are
verified. Rules without mandatory trigrams scan every text.

Texts are addressed by a 64-bit digest, so copies share their postings and a hot group of
copies is one entry; two texts that share a digest only add a candidate, since every
candidate is verified by the expression itself.

Everything is Spark SQL functions. Candidates are broadcast while they are measurably
small, beyond that they are joined by a shuffled hash join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import MAX_BROADCAST_BYTES, broadcast_if_small, staged
from slotfuse.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """`group` must have `least` code points, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

CANDIDATE_BYTES = 64  # of one broadcast candidate, generously

SPAN = "struct<start:int,place:int,kind:string,end:int>"


def digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def rule_spans(text: Column, rule: Rule, place: int) -> Column:
    """Leftmost non-overlapping matches as spans of code points, failing ones dropped.

    What the expression cuts a text into (`split`) and what it takes
    (`regexp_extract_all`) alternate, so their lengths give the positions.
    """
    pattern = F.lit(rule.pattern)
    taken = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else taken
    pieces = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(
        F.transform(F.slice(pieces, F.lit(1), F.size(taken)), F.length).alias("gap"),
        F.transform(taken, F.length).alias("size"),
        F.transform(judged, F.length).alias("judged"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + s["size"]
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        spans = F.when(s["judged"] >= rule.least, F.concat(acc["spans"], F.array(span).cast(f"array<{SPAN}>")))
        return F.struct(end.alias("at"), spans.otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    found = F.aggregate(steps, start, step, lambda acc: acc["spans"])
    return F.when(F.rlike(text, pattern), found).otherwise(none)


def posting_list(docs: DataFrame, grams: Sequence[str]) -> DataFrame:
    """The inverted index: one row (gram, key) per trigram of `grams` in a text."""
    low = F.lower(F.coalesce(F.col("text"), F.lit("")))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in grams]))
    return (
        docs.select(digest(F.col("text")).alias("key"), low.alias("low"))
        .select("key", held.alias("grams"))
        .where(F.size("grams") > 0)
        .groupBy("key").agg(F.first("grams").alias("grams"))
        .select(F.explode("grams").alias("gram"), "key")
    )


def candidates(postings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """key, kinds: texts that hold all trigrams of an alternative of those rules."""
    spark = postings.sparkSession
    terms = [
        (gram, rule.kind, number, len(option))
        for rule in rules
        for number, option in enumerate(trigram_query(rule.pattern) or [])
        for gram in sorted(option)
    ]
    table = spark.createDataFrame(terms, "gram string, kind string, number int, needed int")
    met = (
        postings.join(F.broadcast(table), "gram")  # as long as the rules, never as the data
        .groupBy("key", "kind", "number").agg(F.count(F.lit(1)).alias("held"), F.first("needed").alias("needed"))
        .where(F.col("held") == F.col("needed"))
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def scan_secrets(
    docs: DataFrame, rules: Sequence[Rule] = RULES, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """All rows of `docs` with `spans`: array of start, place, kind, end, in order.

    Spans count code points, the end is exclusive; order is start, then the rules' order.
    NULL and empty texts have none; repeated rows all stay. An empty table gives an empty
    table. The added column replaces one of the same name; helper columns are
    named so that they clash with none.
    """
    gated = [r for r in rules if trigram_query(r.pattern) is not None]
    grams = sorted({g for r in gated for option in trigram_query(r.pattern) for g in option})
    key, kinds = _fresh(docs, "key"), _fresh(docs, "kinds")
    if grams:
        postings = staged(posting_list(docs.select("text"), grams), "secret-postings")
        chosen = staged(candidates(postings, gated), "secret-candidates")
        chosen = chosen.withColumnsRenamed({"key": key, "kinds": kinds})
        chosen = broadcast_if_small(chosen, CANDIDATE_BYTES, max_broadcast_bytes)
        docs = docs.withColumn(key, digest(F.col("text"))).join(chosen, key, "left")
    else:
        docs = docs.withColumns({key: F.lit(0), kinds: F.array().cast("array<string>")})
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for place, rule in enumerate(rules):
        spans = rule_spans(text, rule, place)
        if rule in gated:
            spans = F.when(F.array_contains(F.col(kinds), rule.kind), spans).otherwise(none)
        parts.append(spans)
    return docs.withColumn("spans", F.sort_array(F.concat(*parts))).drop(key, kinds)


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    colon = F.lit(":")
    each = F.transform(spans, lambda s: F.concat(s["kind"], colon, s["start"].cast("string"), colon, s["end"].cast("string")))
    return F.array_join(each, ",")


def secret_digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["place"] < len(BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE_RULES]
    return scanned.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def redact(scanned: DataFrame) -> DataFrame:
    """`scanned` without `spans`; every stretch of text under a span is one `[SECRET]`.

    Overlapping spans are one stretch. A text without spans stays as it is, NULL too.
    """
    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        gap = F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit("[SECRET]"))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, step, lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1))
    )
    return scanned.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))).drop("spans")

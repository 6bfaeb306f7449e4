"""Substring deduplication by content-defined chunks.

A gear rolling hash over the text's bytes puts chunk ends where the last 16 bytes say so,
hence an insertion moves only the chunks around it. Chunks are known by a 128-bit digest;
of equal chunks the first, by doc_id, row and place, stays and the others are repeats.

Neighbouring repeats are one span, and every span is returned, however short. Among texts
of one small vocabulary a few words stand twice by chance, so spans are counted twice over:
`n_spans` counts all, `n_repeats` those of `passage` bytes or more and those that are a
whole text. A passage of 300 bytes holds some five whole chunks, so it is seldom missed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import ship_package, staged

WINDOW, LEAST, MOST, MASK = 16, 16, 512, 31  # bytes; chunks have 48 on average
PASSAGE = 96  # bytes from which a span counts as a passage; shorter ones are returned too
GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of `data`; between LEAST and MOST bytes but for the last."""
    gears = GEAR[np.frombuffer(data, dtype=np.uint8)]
    rolling = gears.copy()
    for k in range(1, min(WINDOW, len(gears))):
        rolling[k:] += gears[:-k] << np.uint32(k)
    ends, last = [], 0
    for cut in (np.flatnonzero((rolling >> np.uint32(WINDOW - 5)) & np.uint32(MASK) == 0) + 1).tolist():
        while cut - last > MOST:
            last += MOST
            ends.append(last)
        if cut - last >= LEAST:
            last = cut
            ends.append(cut)
    while len(data) - last > MOST:
        last += MOST
        ends.append(last)
    return ends if last == len(data) else [*ends, len(data)]


def spans(pieces: Column) -> Column:
    """Sorted pieces (start, end) with neighbours joined."""
    def edge(name: str, other: str, step: int) -> Column:
        inner = lambda p, i: F.coalesce(F.get(pieces, i + step)[other] == p[name], F.lit(False))
        return F.array_compact(F.transform(pieces, lambda p, i: F.when(~inner(p, i), p[name])))

    return F.zip_with(
        edge("start", "end", -1), edge("end", "start", 1), lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    )


def find_repeats(docs: DataFrame, passage: int = PASSAGE, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row with n_chunks, n_spans, n_repeats, repeat_bytes, repeats.

    `repeats` is an array of byte start and end of all spans, `repeat_bytes` their sum.
    NULL and empty texts have no chunks; texts of any length are cut whole. Repeated rows
    all stay, and the whole text of all but one is a repeat, so rows that agree in id and
    text differ in that alone; NULL ids come last. Other columns are not read, and added
    columns replace ones of the same name. An empty table gives an empty table.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<struct<start:int,end:int,digest:binary>>")
    def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                data = text.encode("utf-8", "surrogatepass")
                ends = chunk_ends(data) if data else []
                out.append([{"start": a, "end": b, "digest": xxhash.xxh128_digest(data[a:b])} for a, b in zip([0, *ends], ends)])
            yield pd.Series(out, dtype=object)

    added = ("n_chunks", "n_spans", "n_repeats", "repeat_bytes", "repeats")
    inner = {c: f"kept_{i}" for i, c in enumerate(c for c in keep if c not in added)}
    kept = [F.col(f"`{c}`").alias(n) for c, n in inner.items()]
    rows = docs.select("doc_id", *kept, chunks(F.coalesce(F.col("text"), F.lit(""))).alias("chunks"))
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "substring-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", F.col("c.start").alias("start"))
    each = rows.select("doc_id", "uid", F.explode("chunks").alias("c"))
    each = each.select("uid", place.alias("place"), F.col("c.end").alias("end"), F.col("c.digest").alias("digest"))
    often = each.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1")
    later = each.join(staged(often, "substring-often"), "digest").where("place != first")
    found = later.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct(F.col("place.start").alias("start"), "end"))).alias("pieces"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    sizes = rows.select(
        *inner.values(), "uid", F.size("chunks").cast("long").alias("n_chunks"), F.try_element_at("chunks", F.lit(-1))["end"].alias("n_bytes")
    )
    joined = sizes.join(found, "uid", "left").withColumn("repeats", F.coalesce(spans(F.col("pieces")), none))
    long = F.filter("repeats", lambda s: (s["end"] - s["start"] >= passage) | (s["end"] - s["start"] == F.col("n_bytes")))
    return joined.select(
        *[F.col(n).alias(c) for c, n in inner.items()], "n_chunks", F.size("repeats").cast("long").alias("n_spans"),
        F.size(long).cast("long").alias("n_repeats"),
        F.aggregate("repeats", F.lit(0), lambda acc, r: acc + r["end"] - r["start"]).cast("long").alias("repeat_bytes"),
        "repeats",
    )


def without_repeats(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """All rows and columns of `docs`, each text without its repeats of `passage` bytes or more.

    A repeat's ends are moved to the nearest character boundaries inside it, so what is
    left is whole characters. NULL stays NULL, a text that is one repeat becomes empty.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, repeats: pd.Series) -> pd.Series:
        return pd.Series([
            None if text is None else drop_spans(text, [(r["start"], r["end"]) for r in some], passage)
            for text, some in zip(texts, repeats)
        ], dtype=object)

    inner = [c for c in docs.columns if c != "text"]
    marked = docs.toDF(*[c if c in ("doc_id", "text") else f"own_{i}" for i, c in enumerate(docs.columns)])
    found = find_repeats(marked, passage, marked.columns)
    text = cut(F.col("text"), F.col("repeats")).alias("text")
    back = {f"own_{i}": c for i, c in enumerate(docs.columns) if c in inner and c != "doc_id"}
    return found.select(*[text if c == "text" else F.col(c).alias(back.get(c, c)) for c in marked.columns])


def drop_spans(text: str, repeats: Sequence[tuple[int, int]], passage: int) -> str:
    """The text without those bytes that lie in a repeat long enough, or in one that is all of it."""
    data = text.encode("utf-8", "surrogatepass")
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    left, at = [], 0
    for start, end in repeats:
        if end - start >= passage or end - start == len(data):
            while inside(start):
                start += 1
            while inside(end):
                end -= 1
            left.append(data[at:start])
            at = max(start, end)
    left.append(data[at:])
    return b"".join(left).decode("utf-8", "surrogatepass")

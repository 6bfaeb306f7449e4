"""Token counts by a two-tier lookup on the map side.

A text's tokens are the sum over its pre-tokens, since byte-level BPE never merges across
them. A pre-token never goes on past a character that a single space and then something
other than white space follow, so a text is cut there first, into words with the marks at
them, and what is looked up is the number of tokens of a whole word. The first tier is a
table of the lengths of frequent words, broadcast to every task; the second is a cache in
each Python worker, filled by encoding what the table misses. No word is ever shuffled
outside the table's sample.

The table is a cache and no statistic: it is counted on a bounded sample of about
`sample_rows` rows and holds `table_size` entries at most, and a word that is not in
it is encoded and counted all the same. Words are cut into pre-tokens by the library's own
pre-tokenizer and encoded by its own model, so counts are the library's.

Texts that contain a special token's string go to the library whole, which handles it in
its own way, and so do all texts if the vocabulary is not byte-level BPE (`.json`
without that pre-tokenizer) or is a sentencepiece model (`.model`).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.llm.common import ship_package

SAMPLE_ROWS = 2_000
TABLE_SIZE = 1 << 16  # entries of the broadcast table, about 6 MB
CACHE_SIZE = 1 << 18  # entries of a worker's cache, emptied when it is full
LONGEST = 64  # characters of a word that is kept in a cache
WORD_GAP = re.compile(r" (?=\S)")  # more counts as white space here than to the library, which only cuts less


@lru_cache(maxsize=4)
def _library(path: str):
    """(whole-text counter, tokenizer or None, special strings) for one vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text)), None, ()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = (
        (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
        and spec["normalizer"] is None
        and not spec["pre_tokenizer"].get("add_prefix_space")
        and spec["pre_tokenizer"].get("use_regex", True)
        and spec["model"]["type"] == "BPE"
    )
    specials = tuple(t["content"] for t in spec["added_tokens"])
    count = lambda text: len(tokenizer.encode(text, add_special_tokens=False))
    return count, tokenizer if plain else None, specials


# A worker's second tier, by vocabulary file; it outlives batches and tasks.
_MISSES: dict[str, dict[str, int]] = {}


def text_words(text: str) -> list[str]:
    """The parts of a text that are pre-tokenized alike on their own, all but the first with a space in front."""
    first, *rest = WORD_GAP.split(text)
    return [first, *[" " + word for word in rest]]


def word_length(word: str, tokenizer) -> int:
    """Tokens of a word, by the library's pre-tokenizer and model."""
    tokenize = tokenizer.model.tokenize
    return sum(len(tokenize(piece)) for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(word))


def _count(texts: pd.Series, path: str, table: dict[str, int]) -> list[int]:
    whole, tokenizer, specials = _library(path)
    if tokenizer is None:
        return [whole(text) for text in texts]
    cache = _MISSES.setdefault(path, {})
    counts = []
    for text in texts:
        if any(s in text for s in specials):
            counts.append(whole(text))
            continue
        total = 0
        for word in text_words(text):
            n = table.get(word)
            if n is None:
                n = cache.get(word)
            if n is None:
                n = word_length(word, tokenizer)
                if len(word) <= LONGEST:
                    if len(cache) >= CACHE_SIZE:
                        cache.clear()
                    cache[word] = n
            total += n
        counts.append(total)
    return counts


def frequent_lengths(docs: DataFrame, path: str, sample_rows: int = SAMPLE_ROWS, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """Lengths of the most frequent words of about `sample_rows` texts; copies go together."""
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, tokenizer, _ = _library(path)
        for batch in batches:
            if tokenizer is not None:
                cut = [word for text in batch["text"] for word in text_words(text) if len(word) <= LONGEST]
                seen = pd.Series(cut, dtype=object).value_counts()
                lengths = [word_length(word, tokenizer) for word in seen.index]
                yield pd.DataFrame({"piece": seen.index.astype(str), "n": seen.values, "length": lengths})

    # Chosen by hash, at a rate from the count, so that nothing is gathered in one task; a
    # hot group of copies that is chosen counts as one text.
    rate = min(1 << 40, int(sample_rows / max(1, docs.count()) * (1 << 40)) + 1)
    chosen = F.pmod(F.xxhash64("text", F.lit("token sample")), F.lit(1 << 40)) < rate
    sample = docs.select("text").where(F.col("text").isNotNull() & chosen).distinct()
    counted = sample.mapInPandas(pieces, "piece string, n long, length int")
    top = counted.groupBy("piece").agg(F.sum("n").alias("n"), F.first("length").alias("length"))
    rows = top.orderBy(F.desc("n"), "piece").limit(table_size).collect()
    return {r["piece"]: r["length"] for r in rows}


def count_tokens(docs: DataFrame, path: str, limit: int = 512, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows of `docs` with n_bytes, n_tokens and over_limit (more than `limit` tokens).

    NULL and empty texts have no bytes and no tokens, and texts of any length are counted
    whole. Rows are independent, so repeated rows count alike, and an empty table gives an empty table. Added columns replace ones
    of the same name. `path` must be readable on every executor.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, sample_rows))

    @F.pandas_udf(T.LongType())
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for texts in batches:
            yield pd.Series(_count(texts, path, table), dtype="int64")

    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": n_tokens(text)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Ranked lexical search: term-at-a-time sums of short lists inside document-at-a-time skipping.

Every item is a query against all documents. Documents are cut into their terms once for
each block of items; of a document only the terms that some item of the block asks for
are staged, with their numbers, so the second pass reads postings and no texts. Document
frequencies, the number of documents and of terms are counted over all documents.

The staged postings are searched where they lie, a few thousand documents at a time. In
each step a term has one list of postings, and for each item

1. the short lists are added up, term at a time, into accumulators;
2. the accumulators count as one iterator, whose bound is its greatest sum, beside the
   iterators of the long lists, whose bounds are their greatest entries;
3. iterators in order of their bounds: those whose bounds together stay below the item's
   tenth best score so far cannot bring a new document. Only documents of the others are
   candidates, and the skipped lists are looked up for those that can still get there,
   the greatest bound first.

Scores are whole numbers, so the order of adding changes nothing. A document can only be
left out if ten others are strictly better, so ties are settled by id and results are
exact. What is shuffled is ten rows a task and item.

Items are taken in blocks of `MOST_TERMS` item terms, so a block's broadcast is bounded
however long the benchmark is; an item with more terms is a block of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.llm.common import ship_package, staged

MOST_TERMS = 1 << 18
STEP_DOCS = 4096
STEP_POSTINGS = 1 << 21
SHORT_SHARE = 32  # a list is short if it holds at most 1 of so many documents of a step
TOP = 10

# Term characters are digits, letters and everything beyond ASCII; the rest becomes a blank.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, A-Z in small letters."""
    return text.translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Block:
    """Items of one pass: their rows' numbers, and each one's terms as places in `vocabulary`."""

    rows: list[int]
    asked: list[np.ndarray]
    vocabulary: dict[bytes, int]


def item_blocks(items: DataFrame, most_terms: int = MOST_TERMS) -> Iterator[Block]:
    """Items (row, text) in blocks of at most `most_terms` item terms, or one item.

    Only one block of items is held by the driver at a time.
    """
    rows, asked, vocabulary, size = [], [], {}, 0
    for item in items.select("row", F.col("text").cast("binary").alias("text")).where("text is not null").toLocalIterator():
        wanted = set(terms(bytes(item["text"])))
        if rows and size + len(wanted) > most_terms:
            yield Block(rows, asked, vocabulary)
            rows, asked, vocabulary, size = [], [], {}, 0
        if wanted:
            rows.append(item["row"])
            asked.append(np.array(sorted(vocabulary.setdefault(w, len(vocabulary)) for w in wanted), dtype=np.int64))
            size += len(wanted)
    if rows:
        yield Block(rows, asked, vocabulary)


def staged_postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), ids and tfs (terms of the vocabulary, as often as they stand).

    Documents without any term are left out; they count for nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                if found:
                    counts = [(known[t], c) for t, c in Counter(found).items() if t in known]
                    for values, value in zip(out, (doc_id, len(found), [i for i, _ in counts], [c for _, c in counts])):
                        values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    texts = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return staged(texts.mapInArrow(cut, "doc_id long, n long, ids array<int>, tfs array<long>"), "lexical-postings")


class Best:
    """The best rows of one item so far: highest score first, then the smallest id, NULL last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    @property
    def least(self) -> int:
        """What a document must reach to enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(p) for p in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[:self.top]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class Step:
    """The postings of some documents as one list a term, with entries already weighed."""

    def __init__(self, lengths: np.ndarray, ids: np.ndarray, tfs: np.ndarray, damping: np.ndarray, weights: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(lengths)), lengths)
        entry = weights[ids] * (1_000_000_000 * tfs // (1000 * tfs + 8 * damping[owner]))
        order = np.argsort(ids, kind="stable")
        self.size = len(lengths)
        self.docs, self.entries = owner[order], entry[order]
        self.starts = np.searchsorted(ids[order], np.arange(len(weights) + 1))

    def entries_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[term], self.starts[term + 1])
        return self.docs[part], self.entries[part]

    def search(self, asked: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents with at least `least`, which is 1 or more."""
        counts = self.starts[asked + 1] - self.starts[asked]
        short = counts * SHORT_SHARE <= self.size
        sums = np.zeros(self.size, np.int64)
        for term in asked[short & (counts > 0)]:
            docs, entries = self.entries_of(term)
            sums[docs] += entries
        found = np.flatnonzero(sums)
        iterators = [(int(sums.max(initial=0)), found, sums[found])] if len(found) else []
        for term in asked[~short]:
            docs, entries = self.entries_of(term)
            iterators.append((int(entries.max()), docs, entries))
        iterators.sort(key=lambda x: x[0])
        bounds = np.cumsum([0, *(x[0] for x in iterators)])  # of all iterators before
        first = int(np.searchsorted(bounds, least)) - 1  # the least that can bring a document
        if first == len(iterators):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        scores = np.zeros(self.size, np.int64)
        for _, docs, entries in iterators[first:]:
            scores[docs] += entries
        candidates = np.flatnonzero(scores)
        reached = scores[candidates]
        for i in range(first - 1, -1, -1):
            able = reached + bounds[i + 1] >= least
            candidates, reached = candidates[able], reached[able]
            if not len(candidates):
                break
            _, docs, entries = iterators[i]
            at = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
            reached = reached + np.where(docs[at] == candidates, entries[at], 0)
        able = reached >= least
        return candidates[able], reached[able]


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with few enough documents and postings, or one document."""
    ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        fit = int(np.searchsorted(ends, before + STEP_POSTINGS, side="right")) - at
        size = min(max(fit, 1), STEP_DOCS)
        yield batch.slice(at, size)
        at += size


def search_block(postings: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """row, doc_id, score: the `top` best of every item of the block in each task's documents."""
    shared = postings.sparkSession.sparkContext.broadcast((block.rows, block.asked, weights))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, asked, weight = shared.value
        best = [Best(top) for _ in rows]
        for batch in batches:
            for part in _steps(batch):
                doc_id, n, ids, tfs = part.columns
                damping = 100 - 90 + 90 * n.to_numpy() * n_docs // n_terms
                step = Step(
                    ids.value_lengths().to_numpy(zero_copy_only=False), ids.flatten().to_numpy().astype(np.int64),
                    tfs.flatten().to_numpy(), damping, weight,
                )
                null = doc_id.is_null().to_numpy(zero_copy_only=False)
                doc = doc_id.fill_null(0).to_numpy()
                for mine, wanted in zip(best, asked):
                    docs, scores = step.search(wanted, mine.least)
                    if len(docs):
                        mine.add(scores, doc[docs], null[docs])
        for row, mine in zip(rows, best):
            if len(mine.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine.score), row)), pa.array(mine.doc, mask=mine.null), pa.array(mine.score)], schema=schema
                )

    return postings.mapInArrow(find, "row long, doc_id long, score long")


def term_weights(frequencies: dict[int, int], n_docs: int, size: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) by term; one that no document holds is never met."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequencies.get(i, 0) + 1))) for i in range(size)], dtype=np.int64)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, most_terms: int = MOST_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of `items` its `top` best rows of `docs`.

    `docs` has doc_id (integer) and text, `items` has item_id and text; other columns are
    not read. Only scores above 0 count; equal ones rank by ascending doc_id, NULL last,
    and repeated rows each take a rank. Items and documents that are NULL, empty or hold
    no term have no rows, repeated items have their rows each. Very long texts are read
    whole. An empty table on either side gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = staged(items.select("item_id", "text").withColumn("row", F.monotonically_increasing_id()), "lexical-items")
    found = []
    for block in item_blocks(items, most_terms):
        postings = staged_postings(docs, block.vocabulary)
        totals = postings.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
        if not totals["n_docs"]:
            break
        counted = postings.select(F.explode("ids").alias("id")).groupBy("id").count().collect()  # as long as the vocabulary
        weights = term_weights({r["id"]: r["count"] for r in counted}, totals["n_docs"], len(block.vocabulary))
        found.append(staged(search_block(postings, block, weights, totals["n_docs"], totals["n_terms"], top), "lexical-found"))
    if not found:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(items.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")

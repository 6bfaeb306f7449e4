"""Benchmark decontamination by latent semantic retrieval.

Passages of texts and benchmark items are TF-IDF vectors over the benchmark's words,
taken into a latent space by a randomised SVD (`latent`). A passage near an item by
cosine is a candidate. Candidates are checked word by word, in all windows around the
passage: by the share of the item's words in the longest common subsequence, and, for
paraphrases that reach a lower share only, by the share of the item's answer (its last
words) that stands there in order.

Document frequencies are counted over all documents, and the SVD is fitted on the benchmark
and all passages of all documents. These weigh as much as those of `corpus_docs` documents,
so that the benchmark is not lost in a large corpus. The exact checks do not depend on it.
Documents are never shuffled, only sums by word are, and what is found in them, by the
digest of the text.

The benchmark is taken in blocks of at most `block_items` items and `block_vocabulary`
words (or one item). A block's vectors are broadcast while it is searched and destroyed
before the next block begins, so one broadcast lives at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import broadcast_if_small, ship_package, staged
from slotfuse.llm.latent import plain_words, randomised_svd, word_ids

LEAK = "item_id bigint, start int, end int, cosine double, share double, answer boolean"
LEAK_BYTES = 128
WORDS_AT_ONCE = 20_000  # of texts that are searched together, to bound the arrays


@dataclass(frozen=True)
class Search:
    block_words: int = 24  # passages are two blocks long and start at every block
    dimensions: int = 192
    cosine: float = 0.55
    idf_power: float = 2.0  # rare words tell items apart, common ones only languages
    share: float = 0.8
    paraphrase_share: float = 0.55
    answer_words: int = 5
    answer_share: float = 0.4
    least_matched: int = 8  # words that must agree, or all if an item has fewer
    block_items: int = 2048
    block_vocabulary: int = 1 << 15
    corpus_docs: int = 2000  # as many as all documents weigh in the SVD, beside the benchmark
    sample_parts: int = 12  # tasks that add up the products over all documents


def bit_places(words: list[bytes]) -> dict[bytes, int]:
    """For each word the places, as bits, where it stands."""
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def common_subsequence(masks: dict[bytes, int], size: int, text: list[bytes]) -> int:
    """Length of the longest common subsequence, all rows of a column at once as bits."""
    full = (1 << size) - 1
    state = full
    for word in text:
        mask = masks.get(word)
        if mask:
            met = state & mask
            state = ((state + met) | (state - met)) & full
    return size - state.bit_count()


class Items:
    """One block of benchmark items with their vectors, ready to be searched."""

    def __init__(self, keys, texts, vocabulary, idf, basis, search: Search) -> None:
        self.keys, self.texts, self.vocabulary, self.search = keys, texts, vocabulary, search
        self.masks = [bit_places(t) for t in texts]
        self.answers = [t[-search.answer_words:] for t in texts]
        self.answer_masks = [bit_places(t) for t in self.answers]
        self.vectors = np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
        rows = np.stack([self.vectors[word_ids(t, vocabulary)].sum(axis=0) for t in texts])
        self.rows = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        sizes = np.array([len(t) for t in texts])
        # A short item fills only a part of a passage.
        self.limits = (search.cosine * np.minimum(1, np.sqrt(sizes / (2 * search.block_words)))).astype(np.float32)

    def leaks(self, texts: list[list[bytes]]) -> Iterator[tuple]:
        """(place of the text, item, start, end, cosine, share, answer) for what leaks in `texts`."""
        size = self.search.block_words
        blocks = [max(1, -(-len(t) // size)) for t in texts]
        ids = np.full(sum(blocks) * size, len(self.vocabulary), dtype=np.int64)
        first = np.cumsum([0, *blocks])
        for text, at in zip(texts, first):
            ids[at * size:at * size + len(text)] = word_ids(text, self.vocabulary)
        sums = self.vectors[ids].reshape(-1, size, self.vectors.shape[1]).sum(axis=1)
        owner = np.repeat(np.arange(len(texts)), blocks)
        passages = sums.copy()
        joined = owner[1:] == owner[:-1]
        passages[:-1][joined] += sums[1:][joined]
        norms = np.linalg.norm(passages, axis=1, keepdims=True)
        cosines = passages @ self.rows.T / np.maximum(norms, 1e-9)
        places, items = np.nonzero(cosines >= self.limits)
        order = np.lexsort((places, items))
        run: list[int] = []
        for n, o in enumerate(order):
            place, item = int(places[o]), int(items[o])
            run.append(place)
            after = order[n + 1] if n + 1 < len(order) else None
            if after is None or items[after] != item or owner[places[after]] != owner[place] or places[after] > place + 2:
                doc = int(owner[place])
                found = self._check(item, texts[doc], (run[0] - first[doc]) * size, (place - first[doc] + 2) * size)
                if found:
                    start, end, share, answer = found
                    yield doc, self.keys[item], start, end, float(cosines[run, item].max()), share, answer
                run = []

    def _check(self, item: int, text: list[bytes], start: int, end: int) -> tuple | None:
        """The window that leaks with the greatest share, then the fullest answer, then the first."""
        wanted, search = self.texts[item], self.search
        n = len(wanted)
        start, end = max(0, start - n), min(len(text), end + n)
        best = None
        # Windows half as long again as the item, so that common words far apart do not add up.
        for a in range(start, max(start + 1, end - n // 2), max(1, n // 2)):
            part = text[a:a + n + n // 2]
            matched = common_subsequence(self.masks[item], n, part)
            if matched < min(n, max(search.least_matched, search.paraphrase_share * n)):
                continue
            answer = common_subsequence(self.answer_masks[item], len(self.answers[item]), part) / len(self.answers[item])
            whole = answer >= search.answer_share
            if (matched >= search.share * n or whole) and (best is None or (matched, answer) > best[0]):
                best = (matched, answer), (a, a + len(part), matched / n, whole)
        return best and best[1]


def document_frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """In how many documents each word of the vocabulary stands, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("word", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for text in batch.column(0):
                total[[known[w] for w in set(plain_words(text.as_py())) if w in known]] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], schema=schema)

    texts = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    summed = texts.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary))
    out[summed["word"].to_numpy()] = summed["n"].to_numpy()  # as long as the vocabulary of a block
    shared.destroy()
    return out


def benchmark_blocks(benchmark: DataFrame, search: Search) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Items (id, words) in blocks; items without words cannot leak and are left out.

    Only one block is held by the driver at a time.
    """
    keys, texts, words = [], [], set()
    for row in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        tokens = plain_words(row["text"])
        if not tokens:
            continue
        if texts and (len(keys) == search.block_items or len(words.union(tokens)) > search.block_vocabulary):
            yield keys, texts
            keys, texts, words = [], [], set()
        keys.append(row["item_id"])
        texts.append(tokens)
        words.update(tokens)
    if keys:
        yield keys, texts


def text_key(text: str | Column = "text") -> Column:
    """Digest by which what is found in a text is joined to its rows."""
    return F.md5(F.col(text).cast("binary") if isinstance(text, str) else text)


def _search(docs: DataFrame, items: Items) -> DataFrame:
    """key and the columns of LEAK, for all texts with a leak; copies of a text give theirs once."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = pa.schema([
        ("key", pa.string()), ("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("cosine", pa.float64()),
        ("share", pa.float64()), ("answer", pa.bool_()),
    ])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            keys, some, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key)
                some.append(plain_words(text.as_py()))
                size += len(some[-1]) + 1
                if size > WORDS_AT_ONCE:
                    yield from told(block, keys, some)
                    keys, some, size = [], [], 0
            if some:
                yield from told(block, keys, some)

    def told(block: Items, keys: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        rows = [(keys[doc].as_py(), *more) for doc, *more in block.leaks(texts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    texts = docs.where("text is not null").select(text_key().alias("key"), F.col("text").cast("binary").alias("text"))
    found = staged(texts.mapInArrow(find, f"key string, {LEAK}").dropDuplicates(["key", "item_id", "start"]), "leaks")
    shared.destroy()
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """key (`text_key` of a text) and what leaks in it, one row per item and stretch of text.

    item_id, the words start to end that were compared, cosine, share of the item's words,
    answer (whether enough of it stands there). Of windows with equal shares the one with
    more of the answer counts, then the first. NULL, empty and very short texts are
    searched like others and have no leaks without an item's words; texts of any length are
    searched whole. Copies of a text share their leaks. Items without id keep a NULL id,
    repeated items leak once each by id. An empty table on either side gives none.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = None
    found = []
    for keys, texts in benchmark_blocks(benchmark, search):
        if total is None:
            total = docs.count()
        listed = sorted({w for t in texts for w in t})
        vocabulary = {w: i for i, w in enumerate(listed)}
        idf = (np.log((1 + total) / (1 + document_frequencies(docs, vocabulary))) + 0.1) ** search.idf_power
        _, basis = randomised_svd(
            docs, [word_ids(t, vocabulary) for t in texts], vocabulary, idf, search.dimensions, 2 * search.block_words,
            weight=min(1.0, search.corpus_docs / max(1, total)), parts=search.sample_parts, precision=np.float32,
        )
        found.append(_search(docs, Items(keys, texts, vocabulary, idf, basis, search)))
    if not found:
        return spark.createDataFrame([], f"key string, {LEAK}")
    return reduce(DataFrame.unionByName, found)


def leaks_of_rows(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), search: Search = Search()) -> DataFrame:
    """The columns `keep` of every row with a leak, once for each, and the columns of LEAK.

    Repeated rows leak alike; the leaks' columns replace ones of the same name.
    """
    added = [c.split()[0] for c in LEAK.split(", ")]
    inner = {c: f"kept_{i}" for i, c in enumerate(c for c in keep if c not in added)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], text_key().alias("key"))
    found = broadcast_if_small(find_leaks(docs, benchmark, search), LEAK_BYTES)
    return rows.join(found, "key").select(*[F.col(n).alias(c) for c, n in inner.items()], *added)


def decontaminate(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; columns as they are.

    Rows without text stay. Repeated rows share their fate.
    """
    keys = staged(find_leaks(docs, benchmark, search).select(F.col("key").alias("leak_key")).distinct(), "leak-keys")
    return docs.join(broadcast_if_small(keys, LEAK_BYTES), text_key(docs["text"].cast("binary")) == keys["leak_key"], "left_anti")

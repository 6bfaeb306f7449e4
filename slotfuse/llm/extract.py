"""Main text of web pages: parse to blocks, label them, join what is article."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.blocks import leaf_blocks
from slotfuse.llm.common import ship_package
from slotfuse.llm.labeller import label_pages, train

CHARS = 2_000_000  # of HTML parsed at a time, at most, or one page


def main_texts(pages: Sequence[str], weights) -> list[str]:
    parsed = [leaf_blocks(p) for p in pages]
    labels = label_pages(parsed, weights)
    return ["\n".join(b.text for b, main in zip(blocks, mains) if main) for blocks, mains in zip(parsed, labels)]


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows of `pages` with text, the article, and n_chars, its code points.

    White space inside a block (as Unicode has it, line breaks of `<br>` included) is one
    space, blocks are joined by a line feed in page order. NULL or empty html, or a page
    without an article, gives an empty text. Pages are independent, so repeated rows
    give the same; an empty table gives an empty table. Added columns replace ones of the
    same name. The labeller is trained once per driver process and broadcast (about
    150 kB).
    """
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(train())

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value
        for batch in batches:
            out: list[str] = []
            some: list[str] = []
            size = 0
            for page in batch:
                some.append(page)
                size += len(page)
                if size > CHARS:
                    out += main_texts(some, weights)
                    some, size = [], 0
            if some:
                out += main_texts(some, weights)
            yield pd.Series(out, dtype=object)

    text = extract(F.coalesce(F.col(html), F.lit("")))
    return pages.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))

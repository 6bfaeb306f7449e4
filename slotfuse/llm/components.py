"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang every node's larger (or smaller) neighbours on the least node around it."""
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.union(back) if large else links
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with a link; root is the least node of its component.

    `links` has two columns of ordered type, a and b. Minima are combined before they
    are shuffled and neighbourhoods are never gathered, so a node with very many links is
    no single task. Each round is staged; only one row, the state's checksum, comes to
    the driver. No links give an empty table.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, seen = staged(links, "links"), None
    for _ in range(most_rounds):
        mark = state.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("bit_xor(xxhash64(b, a, 1))").alias("y")
        ).first()
        if mark == seen or mark["n"] == 0:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        state = staged(_star(_star(state, True), False), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")

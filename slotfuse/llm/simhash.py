"""SimHash near-duplicates, linked by BK-trees.

Fingerprints of equal texts are equal, so trees hold distinct fingerprints only. Two
fingerprints at most r bits apart agree in at least c - r of any c blocks the bits are
cut into. Every choice of c - r blocks, with the bits in them, names a shard, and a pair
within r bits meets in at least one. Each shard is one BK-tree, built where its members
have been shuffled to and searched along the edges within the radius.

A tree over all fingerprints would have to be broadcast and grows with the data; a shard
tree lives in one task and is sized instead: blocks are cut finer as there are more
fingerprints, so that shards stay near `shard_goal` members. A shard that is larger than
`most_in_shard` all the same (fingerprints of one crowded neighbourhood) is dealt out:
its members go to tiles by hash, and every pair of tiles is a tree of its own, so that no
link is lost and no task holds more than two tiles.

Inside a shard only links to the least member of a class are emitted, never all pairs;
classes over all shards are then joined by `components`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.llm.bktree import shard_links
from slotfuse.llm.common import broadcast_if_small, ship_package, staged
from slotfuse.llm.components import components

BITS = 64
SHARD_GOAL = 256
MOST_IN_SHARD = 4096
DROPPED_BYTES = 32  # of one broadcast row number, generously


def fingerprint(text: str, shingle: int) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words.

    A-Z are lowered and words cut at ASCII white space, both of which `bytes` does so.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    last = ends[shingle - 1:].tolist() if len(tokens) >= shingle else [len(joined)]
    first = [0, *(ends + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first, last)], dtype=np.uint64)
    votes = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 14):
        some = hashes[part:part + (1 << 14)]
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = 4) -> Column:
    """The fingerprint's 64 bits as a long."""
    @F.pandas_udf(T.LongType())
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return simhash(F.coalesce(text, F.lit("")))


def cut(count: int, radius: int, shard_goal: int = SHARD_GOAL) -> list[int]:
    """Masks of the block choices for `count` fingerprints: the fewest that keep shards small."""
    for blocks in range(radius + 1, 2 * radius + 2):
        edges = [BITS * i // blocks for i in range(blocks + 1)]
        pieces = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        chosen = [sum(c) for c in combinations(pieces, blocks - radius)]
        if count / 2 ** min(m.bit_count() for m in chosen) <= shard_goal:
            break
    return chosen


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_links(
    prints: DataFrame, radius: int, shard_goal: int = SHARD_GOAL, most_in_shard: int = MOST_IN_SHARD
) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`, enough to give the classes."""
    masks = [F.lit(_signed(m)) for m in cut(prints.count(), radius, shard_goal)]
    keyed = prints.select(
        "fp", F.posexplode(F.transform(F.array(*masks), lambda m: m.bitwiseAND(F.col("fp")))).alias("choice", "bits")
    )
    sizes = keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n"))
    large = staged(sizes.where(F.col("n") > most_in_shard), "simhash-large-shards")
    tiles = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / most_in_shard).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles").cast("long")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    tile_pairs = F.transform(others, lambda t: F.struct(F.least(t, F.col("own")).alias("x"), F.greatest(t, F.col("own")).alias("y")))
    single = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    dealt = (
        keyed.join(large, ["choice", "bits"], "left").withColumn("tiles", tiles).withColumn("own", own)
        .select("fp", "choice", "bits", F.explode(F.when(F.col("tiles") > 1, tile_pairs).otherwise(single)).alias("t"))
        .select("fp", F.xxhash64("choice", "bits", "t.x", "t.y").alias("shard"))
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Shards arrive sorted, one after another, perhaps across batches."""
        shard, members = None, []

        def links() -> pd.DataFrame:
            found = shard_links(members, radius) if len(members) > 1 else []
            return np.array(found, dtype=np.uint64).reshape(-1, 2)

        for batch in batches:
            out = []
            for key, group in zip(*_runs(batch["shard"].to_numpy(), batch["fp"].to_numpy())):
                if key != shard:
                    if len(members) > 1:
                        out.append(links())
                    shard, members = key, []
                members.extend(group)
            if out:
                yield _link_frame(np.concatenate(out))
        if len(members) > 1:
            yield _link_frame(links())

    placed = dealt.repartition("shard").sortWithinPartitions("shard")
    return placed.mapInPandas(search, "a long, b long")


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Runs of equal keys, with the unsigned values in them."""
    if not len(keys):
        return [], []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    parts = np.split(values.view(np.uint64), starts[1:])
    return keys[starts].tolist(), [p.tolist() for p in parts]


def _link_frame(found: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(found.view(np.int64).reshape(-1, 2), columns=["a", "b"])


def _classes(marked: DataFrame, radius: int) -> DataFrame:
    """fp, component_id and `best`, the row that stands for the component, from id, uid, fp."""
    # NULL ids last, so that a component's least id is found if it has one.
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "uid")
    prints = staged(marked.groupBy("fp").agg(F.min(rank).alias("least")), "simhash-distinct")
    roots = components(near_links(prints.select("fp"), radius))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("best"))
    return staged(
        rooted.join(least, "root").select("fp", F.col("best.id").alias("component_id"), F.col("best.uid").alias("best")),
        "simhash-classes",
    )


def _marked(docs: DataFrame, columns: dict[str, str], shingle: int) -> DataFrame:
    """Staged rows with their fingerprint, and a row number that staging makes lasting."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").alias("id"), *[F.col(f"`{c}`").alias(n) for c, n in columns.items()],
        fingerprints(F.col("text"), shingle).alias("fp"),
    )
    return staged(rows.withColumn("uid", F.monotonically_increasing_id()), "simhash-prints")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, radius: int = 4, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns `keep` of every row, with fp (long), fingerprint (hex) and component_id.

    component_id is the smallest doc_id that links of at most `radius` bits reach, the
    row's own included; NULL ids count for no minimum, and a class of them alone has a
    NULL component. NULL and empty texts have fingerprint zero and link like any other.
    Repeated rows all stay. An empty table gives an empty table. Columns of `docs` that
    are not in `keep` are not read, and added columns replace ones of the same name.
    """
    added = ("fp", "fingerprint", "component_id")
    inner = {c: f"kept_{i}" for i, c in enumerate(c for c in keep if c not in added)}
    marked = _marked(docs, inner, shingle)
    return marked.join(_classes(marked, radius), "fp").select(
        *[F.col(n).alias(c) for c, n in inner.items()], "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """`docs` with one row of each component: the one with the smallest doc_id.

    Of rows equal in doc_id one stays too. Texts are staged once and not shuffled: the
    rows to drop are broadcast while they are few, and else joined by a shuffled hash
    join.
    """
    inner = {c: f"kept_{i}" for i, c in enumerate(docs.columns)}
    marked = _marked(docs, inner, shingle)
    worse = marked.select("fp", "uid").join(_classes(marked, radius), "fp").where("uid != best").select("uid")
    worse = broadcast_if_small(staged(worse, "simhash-dropped"), DROPPED_BYTES)
    return marked.join(worse, "uid", "left_anti").select(*[F.col(n).alias(c) for c, n in inner.items()])

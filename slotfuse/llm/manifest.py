"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent through it.

Rows become leaves, leaves become trees of runs of eight, one tree per language, and the
trees' roots become the runs of one tree above them. What is stored is a table of records
from a node's digest to the digests of its children, by the node's height above its leaves.

A proof is found from above: a request for leaf number `rank` starts at the root, reads
the root's record, takes the child that the rank's highest octal digit names, keeps the
other children as the siblings of that step, and so on down to the leaf. The steps, in
reverse order, are the proof. Requests below one node travel as one row until they
part, so the records near the root are read once and are no hot keys.

Ranks come from one range sort of the leaves; a row's number within its language is its
place in its sorted partition and the rows in the partitions before. No window runs over a
language, and only leaves and digests are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotfuse.llm.common import ascii_lower, broadcast_if_small, staged

DIGIT_BITS = 3  # eight children a node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
COUNT_BYTES = 96  # of one row of counts, generously


def framed(value: Column) -> Column:
    """`-` for NULL, else the value's UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """Digest of a document's fields; `replaced` gives other values for some of them."""
    return F.sha2(F.concat(*[framed(replaced.get(c, F.col(c))) for c in FIELDS]), 256)


def tree_key(lang: Column) -> Column:
    """Text that sorts as the language does, NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` with rank (from 0 within `tree`, by `order`) and n, the leaves of the tree.

    `order` must tell all rows of a tree apart, so that a repeated task sorts alike.
    """
    order = ["tree", *order]
    in_order = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(in_order.withColumn("place", F.monotonically_increasing_id()), "manifest-placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    counts = staged(
        placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("here")), "manifest-counts"
    )
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    starts = counts.select(
        "tree", "part", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(whole).alias("n"),
    )
    joined = placed.join(broadcast_if_small(starts, COUNT_BYTES), ["tree", "part"])
    return joined.withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _up(value: str | Column, levels: int) -> Column:
    return F.shiftright(value, DIGIT_BITS * levels)


def _runs(n: str) -> Column:
    """How many runs n nodes make."""
    return _up(F.col(n) + F.lit((1 << DIGIT_BITS) - 1), 1)


def grow(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Trees over (tree, rank, digest, n): their roots (tree, digest, n), and the records.

    The i-th table of records holds (digest, children) of the nodes of height i + 1. `n` is
    the number of leaves again.
    """
    level = leaves.select("tree", "rank", "digest", "n", F.col("n").alias("now"))
    most = level.agg(F.max("n")).first()[0] or 0
    tops, records = [], []
    while most > 1:
        tops.append(level.where("now = 1"))
        runs = level.where("now > 1").groupBy("tree", "n", "now", _up("rank", 1).alias("rank")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"]).alias("children")
        )
        made = runs.select(
            "tree", "rank", F.sha2(F.array_join("children", ""), 256).alias("digest"), "n", _runs("now").alias("now"), "children"
        )
        made = staged(made, "manifest-nodes")
        # Equal subtrees, of repeated rows, are one record.
        records.append(made.groupBy("digest").agg(F.first("children").alias("children")))
        level = made.drop("children")
        most = -(-most >> DIGIT_BITS)
    tops.append(level.where("now = 1"))
    return reduce(DataFrame.union, tops).select("tree", "digest", "n"), records


def _step(parents: DataFrame, digit: Column) -> DataFrame:
    """From rows with children to the child that `digit` names, if any; the others join the path."""
    left = F.array_join(F.slice("children", F.lit(1), digit.cast("int")), "")
    right = F.array_join(F.filter("children", lambda _, i: i > digit), "")
    path = F.array_append("path", F.struct(left.alias("left"), right.alias("right")))
    return parents.withColumns({"digest": F.get("children", digit.cast("int")), "path": path}).where("digest is not null")


def descend(tops: DataFrame, records: Sequence[DataFrame], requests: DataFrame) -> DataFrame:
    """`requests` (tree, rank, more) with the leaf's digest and its path from the tree's top.

    `tops` has (tree, digest, n, path, more), one row for each tree. At each height the rows
    are the nodes that some request passes, met with that height's records by digest.
    """
    tops = tops.withColumns({"at": F.lit(0).cast("long"), "height": _height("n", len(records))})
    waiting, here = tops, None
    for height in range(len(records), 0, -1):
        start = waiting.where(F.col("height") == height)
        here = start if here is None else here.unionByName(start)
        parents = here.join(records[height - 1], "digest")
        if height == 1:
            asked = requests.withColumn("at", _up("rank", 1))
            met = asked.join(parents.drop("n", "height"), ["tree", "at"])
            here = _step(met, F.col("rank") % (1 << DIGIT_BITS)).drop("at", "children")
        else:
            passed = requests.select("tree", _up("rank", height - 1).alias("at")).distinct()
            child = passed.withColumns({"parent": _up("at", 1), "digit": F.col("at") % (1 << DIGIT_BITS)})
            met = child.join(parents.withColumnRenamed("at", "parent"), ["tree", "parent"])
            here = _step(met, F.col("digit")).drop("children", "parent", "digit")
    lone = requests.join(waiting.where("height = 0").drop("n", "height", "at"), "tree")
    return lone if here is None else here.select(lone.columns).unionByName(lone)


def _height(n: str, most: int) -> Column:
    """Levels above n leaves: the runs of eight until one node is left."""
    higher = [F.when(F.col(n) > (1 << DIGIT_BITS * i), 1).otherwise(0) for i in range(most)]
    return reduce(lambda a, b: a + b, higher, F.lit(0))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf has with the siblings of `path`, given from the leaf upwards."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, rank, n, leaf and what was asked for; subroots: tree, digest, n, rank;
    records and top_records: (digest, children) by height, from 1; root: one row, or none."""

    leaves: DataFrame
    subroots: DataFrame
    records: list[DataFrame]
    top_records: list[DataFrame]
    root: DataFrame

    def store(self) -> DataFrame:
        """All records as one table: digest, children."""
        every = [*self.records, *self.top_records]
        if not every:
            return self.root.select("digest", F.array().cast("array<string>").alias("children")).limit(0)
        return reduce(DataFrame.unionByName, every)


def build_manifest(docs: DataFrame, keep: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of the rows of `docs` (doc_id, source, lang, n_chars, text).

    Leaves ascend by doc_id within their language, a NULL id before all others; rows with
    equal ids follow their digests, so any order of the input gives the same root. `keep`
    names columns computed on the rows that stay beside the leaves. NULL values, empty and
    very long texts are digested like any other value. An empty table has no root.
    """
    extra = {f"kept_{name}": column.alias(f"kept_{name}") for name, column in (keep or {}).items()}
    rows = docs.select("doc_id", tree_key(F.col("lang")).alias("tree"), leaf_digest().alias("digest"), *extra.values())
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "manifest-leaves")
    leaves = staged(ranked(rows, ["doc_id", "digest", "uid"]).drop("uid"), "manifest-ranked")
    subroots, records = grow(leaves)
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("branch"), F.col("n").alias("leaves"), "digest")
    subroots = staged(ranked(subroots, ["branch"]), "manifest-subroots")
    root, top_records = grow(subroots)
    return Manifest(leaves, subroots, records, top_records, root)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """`requests` (tree, rank, more; default: all leaves) with leaf, subroot, root and path.

    `path` holds the siblings from the leaf up to the root, left and right of the node, as
    joined digests. Requests may repeat; one for a rank that does not exist has no row.
    """
    asked = manifest.leaves.drop("digest", "n") if requests is None else requests
    root = manifest.root.withColumns({"path": F.array().cast(PATH), "root": F.col("digest")})
    branches = manifest.subroots.select("tree", "rank", "branch", "leaves")
    tops = descend(root, manifest.top_records, branches)
    tops = tops.select(F.col("branch").alias("tree"), F.col("leaves").alias("n"), "digest", "path", "root", F.col("digest").alias("subroot"))
    found = descend(staged(tops, "manifest-tops"), manifest.records, asked)
    return found.withColumn("path", F.reverse("path")).withColumnRenamed("digest", "leaf")


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def tampered_leaf(every: int = 3) -> Column:
    """For rows whose id's CRC-32 `every` divides, the leaf with A-Z of the text in small
    letters; NULL for the others, and for rows without an id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    small = F.when(F.col("text").isNotNull(), ascii_lower(F.col("text")))
    return F.when(hit, leaf_digest(text=small))


def verify_rows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proofs are those of the table as it is; the folded root starts from the tampered
    leaf where there is one, so `verified` is false exactly where tampering changed a text.
    """
    manifest = build_manifest(docs, keep={"tampered": tampered_leaf()})
    proven = prove(manifest)
    folded = fold(F.coalesce("kept_tampered", "leaf"), F.col("path"))
    proven = proven.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": folded})
    verified = F.col("folded_root") == F.col("root")
    return proven.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified.alias("verified"))

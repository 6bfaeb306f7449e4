"""Symmetric boosted trees with an L2 leaf term, fitted by Spark aggregates.

Every tree has one split a level, for all of its nodes. A round fits a tree for each margin:
one for two classes (logistic loss), one for each class beyond that (softmax). A level
is one aggregate over all rows: gradients and Hessians by node, feature and bin. The driver
sees that table, whose size is fixed by depth, features and bins, and chooses the split
with the greatest sum of G^2 / (H + l2) over the nodes' halves. A leaf's value is the
learning rate times G / (H + l2).

Rows are binned and counted once: equal rows are one cell with a number. Cells carry their
margins, which are staged every few rounds together with the trees so far; a fit that names
a folder goes on from there after its driver was lost. Between stagings a margin is the
staged one and the trees since, as one expression.

The fit stops within itself: the accuracy on the held-out cells comes with the next round's
first aggregate, and after `patience` rounds without gain the trees up to the best round
are kept.

The model is a table of nodes; to predict, they become one expression over the features.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse.sources.staging import fresh_path, path_exists

NODES = "round int, tree int, node int, feature int, border double, value double"
MOST_CLASSES = 1000
ACCURACY = -1  # the tree number under which the held-out part's hits are counted


@dataclass(frozen=True)
class Settings:
    iterations: int = 300
    learning_rate: float = 0.01
    depth: int = 4
    l2_leaf_reg: float = 3.0
    patience: int = 50
    bins: int = 32
    stage_every: int = 10


@dataclass(frozen=True)
class Tree:
    """splits: (feature, border's place) by level; values: one for each leaf.

    A row's leaf has bit i set if it lies above the border of level i.
    """

    splits: tuple[tuple[int, int], ...]
    values: tuple[float, ...]

    def sql(self, above: Above) -> str:
        values = ", ".join(f"{v!r}D" for v in self.values)
        return f"get(array({values}), {_leaf(self.splits, above)})" if self.splits else values


# A level's condition as SQL, from a feature and the place of its border.
Above = Callable[[int, int], str]


def _leaf(splits: Sequence[tuple[int, int]], above: Above) -> str:
    return " + ".join(f"if({above(*s)}, {1 << i}, 0)" for i, s in enumerate(splits)) or "0"


def _sum(parts: Sequence[str]) -> str:
    """A balanced sum: hundreds of trees would nest too deep from left to right."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return f"({_sum(parts[:half])} + {_sum(parts[half:])})"


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: (name, SQL expression) of each feature, class labels, borders, trees."""

    features: list[tuple[str, str]]
    labels: list[str]
    borders: list[list[float]]
    rounds: list[list[Tree]]

    def nodes(self) -> Iterator[tuple[int, int, int, int | None, float | None, float | None]]:
        """The trees as rows of `NODES`: node 1 is a root, 2 n and 2 n + 1 lie below n, the
        second one above n's border; a leaf has a value and no border."""
        for r, trees in enumerate(self.rounds, 1):
            for k, tree in enumerate(trees):
                for level, (feature, place) in enumerate(tree.splits):
                    for node in range(1 << level, 2 << level):
                        yield r, k, node, feature, self.borders[feature][place], None
                depth = len(tree.splits)
                for leaf, value in enumerate(tree.values):
                    turned = sum((leaf >> i & 1) << (depth - 1 - i) for i in range(depth))
                    yield r, k, (1 << depth) + turned, None, None, value

    def save(self, spark: SparkSession, path: str) -> None:
        """Tables `features`, `labels` and `nodes` under `path`; they grow with the model only."""
        tables = {
            "features": ([(i, n, e) for i, (n, e) in enumerate(self.features)], "feature int, name string, expression string"),
            "labels": (list(enumerate(self.labels)), "class int, label string"),
            "nodes": (list(self.nodes()), NODES),
        }
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        def rows(name: str, *order: str) -> list:
            return spark.read.parquet(f"{path.rstrip('/')}/{name}").orderBy(*order).collect()

        features = [(r["name"], r["expression"]) for r in rows("features", "feature")]
        found = rows("nodes", "round", "tree", "node")
        borders = [sorted({r["border"] for r in found if r["feature"] == i}) for i in range(len(features))]
        trees: dict[tuple[int, int], dict[int, object]] = {}
        for r in found:
            trees.setdefault((r["round"], r["tree"]), {})[r["node"]] = r
        rounds: list[list[Tree]] = []
        for (r, k), nodes in sorted(trees.items()):
            splits, node = [], nodes[1]
            while node["border"] is not None:
                splits.append((node["feature"], borders[node["feature"]].index(node["border"])))
                node = nodes[2 * node["node"]]
            depth = len(splits)
            values = [
                nodes[(1 << depth) + sum((leaf >> i & 1) << (depth - 1 - i) for i in range(depth))]["value"] for leaf in range(1 << depth)
            ]
            if r > len(rounds):
                rounds.append([])
            rounds[-1].append(Tree(tuple(splits), tuple(values)))
        return cls(features, [r["label"] for r in rows("labels", "class")], borders, rounds)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction_label`, the first by name of equally likely ones."""
        names = [f"_feature_{i}" for i in range(len(self.features))]
        scaled = df.withColumns({n: F.expr(e) for n, (_, e) in zip(names, self.features)})
        if not self.rounds:
            return scaled.withColumn("prediction_label", F.lit(self.labels[0] if self.labels else None).cast("string")).drop(*names)
        def above(feature: int, place: int) -> str:
            return f"coalesce({names[feature]} > {self.borders[feature][place]!r}D, false)"

        marks = [f"_margin_{k}" for k in range(len(self.rounds[0]))]
        margins = {m: F.expr(_sum([trees[k].sql(above) for trees in self.rounds])) for k, m in enumerate(marks)}
        label = F.get(F.array(*[F.lit(x) for x in self.labels]), F.expr(_best_class(marks)))
        return scaled.withColumns(margins).withColumn("prediction_label", label).drop(*names, *marks)


def _best_class(marks: Sequence[str]) -> str:
    """The class with the greatest margin, the first of equal ones; above 0 for one margin."""
    if len(marks) == 1:
        return f"if({marks[0]} > 0, 1, 0)"
    every = ", ".join(marks)
    return f"cast(array_position(array({every}), greatest({every})) as int) - 1"


@dataclass
class _Fit:
    """What a fit knows between two jobs; `saved` rounds are in the staged margins."""

    borders: list[list[float]]
    labels: list[str]
    state: DataFrame
    rounds: list[list[Tree]] = field(default_factory=list)
    watched: list[float] = field(default_factory=list)
    saved: int = 0

    @property
    def trees(self) -> int:
        """Margins, and so trees, in a round."""
        return 1 if len(self.labels) == 2 else len(self.labels)

    @property
    def marks(self) -> list[str]:
        return [f"margin_{k}" for k in range(self.trees)]

    def now(self) -> DataFrame:
        """The cells with margins after all rounds so far."""
        since = self.rounds[self.saved:]
        margins = [f"{_sum([m, *[trees[k].sql(_above_bin) for trees in since]])} as {m}" for k, m in enumerate(self.marks)]
        return self.state.selectExpr(*[c for c in self.state.columns if c not in self.marks], *margins)


def _above_bin(feature: int, place: int) -> str:
    return f"bin_{feature} > {place}"


def borders_of(train: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """For each feature at most `bins` values that rows can lie above.

    These are all values that stand in a fair share of the rows if they are few, else
    quantiles. The greatest value is no border. One aggregate finds all.
    """
    fine = [i / (8 * bins) for i in range(8 * bins + 1)]
    row = train.agg(*[F.percentile_approx(F.col(f).cast("double"), fine, 10_000).alias(f"q_{i}") for i, f in enumerate(features)]).first()
    out = []
    for i in range(len(features)):
        values = [v for v in (row[f"q_{i}"] or []) if v == v]
        distinct = sorted(set(values))
        if len(distinct) > bins + 1:
            distinct = sorted(set(values[::8]))
        out.append(distinct[:-1])
    return out


def _cells(train: DataFrame, features: Sequence[str], label: str, held: str, labels: list[str], borders: list[list[float]]) -> DataFrame:
    """bin_i, y, held, n, margin_k: equal rows counted; a missing value lies in bin 0."""
    def bin_of(i: int) -> Column:
        over = [F.coalesce(F.col(features[i]) > F.lit(b), F.lit(False)).cast("int") for b in borders[i]]
        return reduce(lambda a, b: a + b, over, F.lit(0)).alias(f"bin_{i}")

    y = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)).cast("int") - 1
    keyed = train.select(*[bin_of(i) for i in range(len(features))], y.alias("y"), F.col(held).alias("held"))
    counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counted.withColumns({f"margin_{k}": F.lit(0.0) for k in range(1 if len(labels) == 2 else len(labels))})


def _let(name: str, value: str, body: str) -> str:
    """`body` with `name` for `value`, computed once: margins grow with the trees they are made of."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _slopes(fit: _Fit, leaves: Sequence[str]) -> str:
    """Array of tree, leaf, g, h: gradient and Hessian of each margin times the cell's number.

    SQL text, as a job's plan is built for every level and round.
    """
    def slopes(chances: Sequence[str]) -> str:
        rows = [
            f"named_struct('tree', {k}, 'leaf', {leaf}, 'g', (if(y = {1 if fit.trees == 1 else k}, 1D, 0D) - {p}) * n, 'h', {p} * (1 - {p}) * n)"
            for k, (leaf, p) in enumerate(zip(leaves, chances))
        ]
        return f"array({', '.join(rows)})"

    if fit.trees == 1:
        return _let("p", f"1 / (1 + exp(-{fit.marks[0]}))", slopes(["p"]))
    total = "aggregate(e, 0D, (sum, x) -> sum + x)"
    powers = "transform(m, v -> exp(v - array_max(m)))"
    shares = _let("e", powers, f"transform(e, v -> v / {total})")
    return _let("m", f"array({', '.join(fit.marks)})", _let("p", shares, slopes([f"get(p, {k})" for k in range(fit.trees)])))


def _histograms(fit: _Fit, chosen: list[list[tuple[int, int]]], watch: bool) -> tuple[np.ndarray, float | None]:
    """Sums by (tree, node, feature, bin, g or h), and the held-out share of hits if `watch`."""
    level, cells, n_features = max(map(len, chosen)), fit.now(), len(fit.borders)
    each = _slopes(fit, [_leaf(splits, _above_bin) for splits in chosen])
    bins = ", ".join(f"named_struct('feature', {i}, 'bin', bin_{i})" for i in range(n_features))
    rows = cells.where("not held").selectExpr("*", f"explode({each}) as t").selectExpr("t", f"explode(array({bins})) as b")
    sums = rows.groupBy("t.tree", "t.leaf", "b.feature", "b.bin").agg(F.sum("t.g").alias("g"), F.sum("t.h").alias("h"))
    if watch:
        right = f"{_best_class(fit.marks)} = y"
        hits = cells.where("held").selectExpr(
            f"{ACCURACY} as tree", "0 as leaf", "0 as feature", "0 as bin", f"sum(if({right}, n, 0D)) as g", "sum(n) as h"
        )
        sums = sums.unionByName(hits)
    found = sums.toArrow().to_pydict()  # trees x nodes x features x bins rows at most
    widest = max(len(b) for b in fit.borders) + 1
    out = np.zeros((fit.trees, 1 << level, n_features, widest, 2))
    share = None
    for tree, leaf, feature, place, g, h in zip(*(found[c] for c in ("tree", "leaf", "feature", "bin", "g", "h"))):
        if tree == ACCURACY:
            share = g / h if h else None
        else:
            out[tree, leaf, feature, place] = g, h
    return out, share


def _halves(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a border the sums below and above it; the last place is all below."""
    below = sums.cumsum(axis=-2)
    return below, below[..., -1:, :] - below


def _worth(part: np.ndarray, l2: float) -> np.ndarray:
    g, h = part[..., 0], part[..., 1] + l2
    return np.divide(g * g, h, out=np.zeros_like(g), where=h > 1e-12)


def best_split(sums: np.ndarray, borders: list[list[float]], l2: float) -> tuple[int, int] | None:
    """(feature, border's place) with the greatest worth over all nodes of a tree's level.

    `sums` is by node, feature, bin. Worths that agree to nine digits count as equal, and
    the first feature and border win. None if no split is worth more than the nodes whole.
    """
    below, above = _halves(sums)
    worth = (_worth(below, l2) + _worth(above, l2)).sum(axis=0)
    whole = _worth(below[:, :, -1:], l2).sum(axis=0)
    gains = worth - whole
    for i, some in enumerate(borders):
        gains[i, len(some):] = -np.inf
    most = gains.max(initial=-np.inf)
    if not most > 1e-9 * max(1.0, float(whole.max(initial=0))):
        return None
    first = int(np.argmax(gains.ravel() >= most * (1 - 1e-9)))
    return first // gains.shape[1], first % gains.shape[1]


def _leaf_values(sums: np.ndarray, split: tuple[int, int] | None, settings: Settings) -> list[float]:
    """Values of the leaves below a level's nodes, first all that lie below the split."""
    below, above = _halves(sums)
    parts = [below[:, 0, -1]] if split is None else [below[:, split[0], split[1]], above[:, split[0], split[1]]]
    sums = np.concatenate(parts)
    h = sums[:, 1] + settings.l2_leaf_reg
    return (settings.learning_rate * np.divide(sums[:, 0], h, out=np.zeros(len(h)), where=h > 1e-12)).tolist()


def _fit_round(fit: _Fit, settings: Settings) -> list[Tree]:
    """One tree for each margin; notes the held-out accuracy before the round."""
    chosen: list[list[tuple[int, int]]] = [[] for _ in range(fit.trees)]
    done: list[Tree | None] = [None] * fit.trees
    for level in range(max(1, settings.depth)):
        sums, share = _histograms(fit, chosen, watch=level == 0)
        if level == 0 and share is not None and fit.rounds:
            fit.watched.append(share)
        for k in range(fit.trees):
            if done[k] is None:
                here = sums[k, :1 << len(chosen[k])]
                split = best_split(here, fit.borders, settings.l2_leaf_reg) if settings.depth else None
                values = _leaf_values(here, split, settings)
                if split is not None:
                    chosen[k].append(split)
                if split is None or len(chosen[k]) == settings.depth:
                    done[k] = Tree(tuple(chosen[k]), tuple(values))
        if all(done):
            break
    return [t for t in done if t is not None]


def _best(watched: Sequence[float]) -> int:
    """The round, from 1, with the greatest share of hits, the first of equal ones."""
    return 1 + max(range(len(watched)), key=lambda i: (watched[i], -i))


class _Stages:
    """Staged margins, trees and accuracies of one fit in a folder all executors share."""

    def __init__(self, spark: SparkSession, folder: str, facts: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        if path_exists(spark, f"{self.folder}/facts/_SUCCESS"):
            stored = spark.read.text(f"{self.folder}/facts").first()[0]
            if stored != facts:
                raise ValueError(f"{folder} holds another fit")
        else:
            spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/facts")

    def write(self, fit: _Fit) -> None:
        """Margins first, the trees last: a stage without trees is not whole."""
        n = len(fit.rounds)
        state = f"{self.folder}/cells-{n:06d}"
        fit.now().write.mode("overwrite").parquet(state)
        rows = json.dumps({"rounds": [[(t.splits, t.values) for t in trees] for trees in fit.rounds], "watched": fit.watched})
        self.spark.createDataFrame([(rows,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/trees-{n:06d}")
        fit.state, fit.saved = self.spark.read.parquet(state), n

    def resume(self, fit: _Fit, settings: Settings) -> bool:
        """Take up the last whole stage, if there is one."""
        for n in range(settings.iterations, -1, -1):
            if path_exists(self.spark, f"{self.folder}/trees-{n:06d}/_SUCCESS"):
                stored = json.loads(self.spark.read.text(f"{self.folder}/trees-{n:06d}").first()[0])
                fit.rounds = [[Tree(tuple(map(tuple, s)), tuple(v)) for s, v in trees] for trees in stored["rounds"]]
                fit.watched, fit.saved = stored["watched"], n
                fit.state = self.spark.read.parquet(f"{self.folder}/cells-{n:06d}")
                return True
        return False


def fit_trees(
    train: DataFrame,
    features: Sequence[tuple[str, str]],
    label: str,
    held: str,
    settings: Settings = Settings(),
    folder: str | None = None,
) -> BoostedTrees:
    """Trees over `features` (name, SQL expression over `train`), fitted on the rows not `held`.

    Labels are texts and at most `MOST_CLASSES`; rows without one are left out. Without held
    rows all rounds are fitted and kept. With a `folder` that holds the stages of the same
    fit, on the same rows, it goes on from the last of them.
    """
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    names = [f"_feature_{i}" for i in range(len(features))]
    ready = train.select(*[F.expr(e).cast("double").alias(n) for n, (_, e) in zip(names, features)], F.col(label).alias("_label"), F.col(held).alias("_held"))
    labels = sorted(r[0] for r in ready.select("_label").distinct().limit(MOST_CLASSES + 1).collect())
    if len(labels) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} labels")
    if len(labels) < 2 or not features:
        return BoostedTrees(list(features), labels, [[] for _ in features], [])
    borders = borders_of(ready.where("not _held"), names, settings.bins)
    facts = json.dumps([asdict(settings), list(features), labels, borders])
    stages = _Stages(spark, folder or fresh_path(spark, "boosting"), facts)
    fit = _Fit(borders, labels, _cells(ready, names, "_label", "_held", labels, borders))
    if not stages.resume(fit, settings):
        stages.write(fit)
    while len(fit.rounds) < settings.iterations:
        trees = _fit_round(fit, settings)
        if fit.watched and len(fit.rounds) - _best(fit.watched) >= settings.patience:
            break  # the tree just fitted comes after the last round that counts
        fit.rounds.append(trees)
        if len(fit.rounds) - fit.saved >= settings.stage_every:
            stages.write(fit)
    if fit.rounds and len(fit.watched) < len(fit.rounds):
        _, share = _histograms(fit, [[] for _ in range(fit.trees)], watch=True)
        fit.watched += [] if share is None else [share]
    kept = fit.rounds[:_best(fit.watched)] if fit.watched else fit.rounds
    return BoostedTrees(list(features), labels, borders, kept)

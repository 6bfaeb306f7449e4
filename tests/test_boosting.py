"""Symmetric boosted trees against a plain Python learner, row by row."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from slotfuse.plans import boosting
from slotfuse.plans.boosting import BoostedTrees, Settings, fit_trees


def plain_fit(rows, held, borders, n_classes, settings):
    """(rounds of (splits, values), held-out accuracies): features are rows[i][0], class rows[i][1]."""
    trees = 1 if n_classes == 2 else n_classes
    margins = [[0.0] * trees for _ in rows]
    above = lambda x, f, j: x[f] is not None and x[f] > borders[f][j]

    def chances(m):
        if trees == 1:
            return [1 / (1 + math.exp(-m[0]))]
        e = [math.exp(v - max(m)) for v in m]
        return [v / sum(e) for v in e]

    def best_class(m):
        return int(m[0] > 0) if trees == 1 else m.index(max(m))

    def worth(g, h):
        return g * g / (h + settings.l2_leaf_reg) if h + settings.l2_leaf_reg > 1e-12 else 0.0

    rounds, watched = [], []
    while len(rounds) < settings.iterations:
        made = []
        p = [chances(m) for m in margins]
        for k in range(trees):
            slopes = [((y == (1 if trees == 1 else k)) - p[i][k], p[i][k] * (1 - p[i][k])) for i, (_, y) in enumerate(rows)]
            splits, leaf = [], [0] * len(rows)
            for level in range(settings.depth):
                options = []
                for f, some in enumerate(borders):
                    for j in range(len(some)):
                        sums, whole = {}, {}
                        for i, (x, _) in enumerate(rows):
                            if not held[i]:
                                for table, key in ((sums, (leaf[i], above(x, f, j))), (whole, leaf[i])):
                                    g, h = table.get(key, (0.0, 0.0))
                                    table[key] = g + slopes[i][0], h + slopes[i][1]
                        now, before = (sum(worth(*v) for v in t.values()) for t in (sums, whole))
                        options.append((now - before, f, j, before))
                most = max(o[0] for o in options)
                if not most > 1e-9 * max(1.0, options[0][3]):
                    break
                _, f, j, _ = next(o for o in options if o[0] >= most * (1 - 1e-9))
                splits.append((f, j))
                leaf = [v | above(x, f, j) << level for v, (x, _) in zip(leaf, rows)]
            values = []
            for v in range(1 << len(splits)):
                g, h = (sum(slopes[i][s] for i in range(len(rows)) if leaf[i] == v and not held[i]) for s in (0, 1))
                h += settings.l2_leaf_reg
                values.append(settings.learning_rate * g / h if h > 1e-12 else 0.0)
            made.append((tuple(splits), values))
            for m, v in zip(margins, leaf):
                m[k] += values[v]
        rounds.append(made)
        if any(held):
            hits = [best_class(margins[i]) == y for i, (_, y) in enumerate(rows) if held[i]]
            watched.append(sum(hits) / len(hits))
            if len(rounds) - watched.index(max(watched)) - 1 >= settings.patience:
                break
    kept = rounds[:watched.index(max(watched)) + 1] if watched else rounds
    return kept, watched, [best_class(m) for m in margins]


def make_rows(n, n_classes, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = (rng.randint(0, 6), rng.choice([0.5, 1.5, None, 2.5]), rng.randint(0, 1))
        score = x[0] * 0.5 + (x[1] or 0) * (1 if x[2] else -1) + rng.gauss(0, 0.6)
        out.append((x, min(n_classes - 1, max(0, int(score * n_classes / 4)))))
    return out


def table(spark, rows, held):
    data = [(i, *map(lambda v: None if v is None else float(v), x), f"class {y}", h) for i, ((x, y), h) in enumerate(zip(rows, held))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, label string, held boolean")


FEATURES = [("a", "a"), ("b", "b"), ("c", "c")]


@pytest.mark.parametrize("n_classes, l2", [(2, 3.0), (2, 0.0), (3, 3.0), (4, 10.0)])
def test_trees_equal_a_plain_learner(spark, n_classes, l2):
    rows = make_rows(150, n_classes, n_classes)
    held = [i % 5 == 0 for i in range(len(rows))]
    settings = Settings(iterations=4, learning_rate=0.3, depth=3, l2_leaf_reg=l2, patience=50, stage_every=3)
    model = fit_trees(table(spark, rows, held), FEATURES, "label", "held", settings)
    assert model.labels == sorted({f"class {y}" for _, y in rows})
    kept, _, _ = plain_fit(rows, held, model.borders, n_classes, settings)
    assert [[t.splits for t in trees] for trees in model.rounds] == [[s for s, _ in trees] for trees in kept]
    for mine, theirs in zip(model.rounds, kept):
        for tree, (_, values) in zip(mine, theirs):
            assert tree.values == pytest.approx(values)


def test_the_leaf_term_changes_leaves(spark):
    rows = make_rows(60, 2, 9)
    df = table(spark, rows, [False] * 60)
    values = [
        fit_trees(df, FEATURES, "label", "held", Settings(1, 1.0, 1, l2)).rounds[0][0].values for l2 in (0.0, 3.0, 1000.0)
    ]
    assert abs(values[0][1]) > abs(values[1][1]) > abs(values[2][1]) > 0


def test_the_fit_stops_within_itself_and_can_be_taken_up(spark, tmp_path, monkeypatch):
    rows = make_rows(200, 2, 3)
    held = [i % 4 == 0 for i in range(len(rows))]
    settings = Settings(iterations=40, learning_rate=0.5, depth=2, patience=3, stage_every=2)
    df = table(spark, rows, held)
    whole = fit_trees(df, FEATURES, "label", "held", settings, f"{tmp_path}/whole")
    kept, watched, _ = plain_fit(rows, held, whole.borders, 2, settings)
    assert len(watched) == len(kept) + settings.patience < settings.iterations  # rounds fitted: best and patience
    assert len(whole.rounds) == len(kept)

    fitted = []
    plain_round = boosting._fit_round

    def lost(fit, settings):
        if len(fitted) == 3:
            raise RuntimeError("driver lost")
        fitted.append(len(fit.rounds))
        return plain_round(fit, settings)

    monkeypatch.setattr(boosting, "_fit_round", lost)
    with pytest.raises(RuntimeError):
        fit_trees(df, FEATURES, "label", "held", settings, f"{tmp_path}/lost")
    taken_up = []

    def counted(fit, settings):
        taken_up.append(len(fit.rounds))
        return plain_round(fit, settings)

    monkeypatch.setattr(boosting, "_fit_round", counted)
    again = fit_trees(df, FEATURES, "label", "held", settings, f"{tmp_path}/lost")
    assert fitted == [0, 1, 2] and taken_up[0] == 2  # the last whole stage
    assert [[t.splits for t in trees] for trees in again.rounds] == [[t.splits for t in trees] for trees in whole.rounds]
    for mine, theirs in zip(again.rounds, whole.rounds):
        assert mine[0].values == pytest.approx(theirs[0].values)
    with pytest.raises(ValueError):
        fit_trees(df, FEATURES, "label", "held", Settings(iterations=9), f"{tmp_path}/lost")


@pytest.mark.parametrize("n_classes", [2, 3])
def test_stored_nodes_walked_by_sql_predict_alike(spark, tmp_path, n_classes):
    rows = make_rows(120, n_classes, 21)
    df = table(spark, rows, [False] * len(rows))
    settings = Settings(iterations=4, learning_rate=0.4, depth=3)
    model = fit_trees(df, FEATURES, "label", "held", settings)
    model.save(spark, f"{tmp_path}/model")
    loaded = BoostedTrees.load(spark, f"{tmp_path}/model")
    assert list(loaded.nodes()) == list(model.nodes()) and loaded.labels == model.labels and loaded.features == model.features
    df.select("id", "a", "b", "c").coalesce(1).write.parquet(f"{tmp_path}/rows")
    sql = f"""
        with recursive nodes as (from '{tmp_path}/model/nodes/*.parquet'), x as (select id, unnest([0, 1, 2]) as feature,
            unnest([a, b, c]) as v from '{tmp_path}/rows/*.parquet'),
        walk as (select id, round, tree, 1 as node from (select distinct id from x), (select distinct round, tree from nodes)
            union all select w.id, w.round, w.tree, 2 * w.node + case when x.v > n.border then 1 else 0 end
            from walk w join nodes n using (round, tree, node) join x on x.id = w.id and x.feature = n.feature),
        m as (select id, tree, sum(value) as m from walk join nodes using (round, tree, node) where value is not null group by all),
        best as (select id, case when max(tree) = 0 then cast(max(m) > 0 as int) else arg_max(tree, (m, -tree)) end as class from m group by id)
        select id, label from best join '{tmp_path}/model/labels/*.parquet' using (class) order by id"""
    want = duckdb.connect().execute(sql).fetchall()
    got = [tuple(r) for r in loaded.transform(df).select("id", "prediction_label").orderBy("id").collect()]
    assert got == want
    _, _, plain = plain_fit(rows, [False] * len(rows), model.borders, n_classes, settings)
    assert [g for _, g in got] == [f"class {k}" for k in plain]


def test_many_values_get_quantile_borders_and_missing_ones_lie_below(spark):
    df = spark.range(5000).select(
        (F.col("id") % 997).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(1.0).alias("b"), F.lit(2.0).alias("c"),
    )
    a, b, c = boosting.borders_of(df, ["a", "b", "c"], 16)
    assert 14 <= len(a) <= 17 and a == sorted(set(a)) and c == []
    assert len(b) <= 1


def test_one_class_and_no_rows(spark):
    df = table(spark, [((1, 1.0, 0), 0)] * 5, [False] * 5)
    one = fit_trees(df, FEATURES, "label", "held")
    assert one.rounds == [] and {r["prediction_label"] for r in one.transform(df).collect()} == {"class 0"}
    none = fit_trees(df.limit(0), FEATURES, "label", "held")
    assert none.labels == [] and none.transform(df).first()["prediction_label"] is None

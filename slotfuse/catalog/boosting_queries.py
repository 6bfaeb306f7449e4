"""The boosted-tree learner's own trees, beside SQL that grows the same ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotfuse.catalog.registry import query, rounded, table
from slotfuse.plans.boosting import NODES, Settings, fit_trees

ROUNDS, DEPTH, RATE, L2 = 3, 2, 0.3, 3.0
FEATURES = ("age", "funds", "nation")


def boosting_sql(source: str, classes: list[str]) -> str:
    """SQL for the nodes of ROUNDS rounds over `source` (the features, label).

    Each round and level is a table of its own: sums by node, feature, border and side, the
    split of each tree, and the rows' next nodes.
    """
    trees = 1 if len(classes) == 2 else len(classes)
    names = ", ".join(f"'{c}'" for c in classes)
    values = ", ".join(f"cast({c} as double)" for c in FEATURES)
    target = "y = 1" if trees == 1 else "y = k"
    if trees == 1:
        chance = "1 / (1 + exp(-m))"
    else:
        chance = "exp(m - max(m) over (partition by id)) / sum(exp(m - e)) over (partition by id)"
    parts = [
        f"""cells as (select *, row_number() over () as id from (select x, list_position([{names}], label) - 1 as y, count(*) as n
            from (select [{values}] as x, label from ({source})) group by all))""",
        f"""places as (select distinct f, x[f + 1] as b from cells, range({len(FEATURES)}) r(f))""",
        "borders as (select f, b from places p where b < (select max(b) from places q where q.f = p.f)) ",
        f"margins0 as (select id, x, y, n, k, cast(0 as double) as m from cells, range({trees}) t(k))",
    ]
    nodes = []
    for r in range(1, ROUNDS + 1):
        parts.append(f"peak{r} as (select *, max(m) over (partition by id) as e from margins{r - 1})")
        parts.append(f"chance{r} as (select *, {chance} as p from peak{r})")
        parts.append(
            f"""at{r}_0 as (select id, x, y, n, k, m, 0 as leaf, (cast({target} as int) - p) * n as g, p * (1 - p) * n as h from chance{r})"""
        )
        for level in range(DEPTH):
            here = f"{r}_{level}"
            parts += [
                f"""sides{here} as (select k, f, b, leaf, x[f + 1] > b as above, sum(g) as g, sum(h) as h
                    from at{here}, borders group by all)""",
                f"""whole{here} as (select k, sum(w) as w from (select k, leaf, sum(g) ^ 2 / (sum(h) + {L2}) as w
                    from at{here} group by all) group by k)""",
                f"""gains{here} as (select s.k, f, b, sum(g * g / (h + {L2})) - any_value(w.w) as gain
                    from sides{here} s join whole{here} w on w.k = s.k group by s.k, f, b)""",
                f"""split{here} as (select k, min((f, b)) as fb from gains{here} o
                    where gain >= (select max(gain) from gains{here} i where i.k = o.k) * (1 - 1e-9) group by k)""",
                f"""at{r}_{level + 1} as (select a.* replace (leaf + cast(x[fb[1] + 1] > fb[2] as int) * {1 << level} as leaf)
                    from at{here} a join split{here} using (k))""",
            ]
            nodes.append(f"""select {r} as round, k as tree, node, fb[1] as feature, fb[2] as border, null as value
                from split{here}, range({1 << level}, {2 << level}) n(node)""")
        last = f"at{r}_{DEPTH}"
        turned = " + ".join(f"((l.leaf >> {i}) & 1) * {1 << (DEPTH - 1 - i)}" for i in range(DEPTH))
        parts.append(
            f"""leaves{r} as (select k, l.leaf, coalesce({RATE} * sum(g) / (sum(h) + {L2}), 0) as value
                from range({trees}) t(k) cross join range({1 << DEPTH}) l(leaf) left join {last} using (k, leaf) group by all)"""
        )
        parts.append(f"margins{r} as (select id, x, y, n, a.k, m + value as m from {last} a join leaves{r} l on a.k = l.k and a.leaf = l.leaf)")
        nodes.append(f"select {r}, k, {1 << DEPTH} + {turned}, null, null, value from leaves{r} l")
    every = " union all ".join(nodes)
    return f"""with {", ".join(parts)}
        select cast(round as int) as round, cast(tree as int) as tree, cast(node as int) as node, cast(feature as int) as feature,
        cast(border as double) as border, round(cast(value as double), 6) as value from ({every})"""


def _nodes(spark: SparkSession, rows: DataFrame) -> DataFrame:
    settings = Settings(iterations=ROUNDS, learning_rate=RATE, depth=DEPTH, l2_leaf_reg=L2)
    model = fit_trees(rows.withColumn("held", F.lit(False)), [(c, c) for c in FEATURES], "label", "held", settings)
    return rounded(spark.createDataFrame(list(model.nodes()), NODES), ["value"])


_SQL_ROWS = "select 12 + c_custkey % 6 as age, floor(c_acctbal / 1000) as funds, c_nationkey as nation, {label} as label from customer"


def _rows(spark: SparkSession, sf_dir: str, label) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        (12 + F.col("c_custkey") % 6).alias("age"), F.floor(F.col("c_acctbal") / 1000).alias("funds"),
        F.col("c_nationkey").alias("nation"), label.alias("label"),
    )


@query(boosting_sql(
    _SQL_ROWS.format(label="case when c_acctbal / 1000 + c_custkey % 6 - c_nationkey / 5.0 >= 4 then 'Engaged' else 'Not Engaged' end"),
    ["Engaged", "Not Engaged"],
))
def boosted_nodes(spark, sf_dir):
    """M4: three rounds of symmetric trees over two classes, with the L2 leaf term, as rows."""
    score = F.col("c_acctbal") / 1000 + F.col("c_custkey") % 6 - F.col("c_nationkey") / 5.0
    return _nodes(spark, _rows(spark, sf_dir, F.when(score >= 4, "Engaged").otherwise("Not Engaged")))


@query(boosting_sql(
    _SQL_ROWS.format(label="case when c_acctbal / 1000 + c_custkey % 6 >= 8 then 'high' when c_nationkey + c_custkey % 6 >= 12 then 'low' else 'mid' end"),
    ["high", "low", "mid"],
))
def boosted_nodes_classes(spark, sf_dir):
    """M4: the same over three classes, a tree for each class and round."""
    age = F.col("c_custkey") % 6
    label = F.when(F.col("c_acctbal") / 1000 + age >= 8, "high").when(F.col("c_nationkey") + age >= 12, "low").otherwise("mid")
    return _nodes(spark, _rows(spark, sf_dir, label))

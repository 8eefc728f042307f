"""Trees on line items against trees grown in SQL: all splits of all nodes are scored there, row by row."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pricewright.operators.boosting import BoostedTrees
from pricewright.operators.models import ModelSpec, apply_model, fit_model
from pricewright.queries import sql as Q
from pricewright.queries.numbers import LINE_KEY, rounded
from pricewright.queries.registry import query
from pricewright.queries.vectors import line_features

NAMES = ["pack_count", "value", "name_length", "line"]  # at most 50 values each
_SID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
_ROWS = f"""{Q.LINE}, feat AS (SELECT {_SID} AS sample_id, ln(1 + price) AS y, [pack_count::DOUBLE, value, length(item_name)::DOUBLE, l_linenumber::DOUBLE] AS x FROM line),
a0 AS (SELECT 1::BIGINT AS node, sample_id, y, (SELECT avg(y) FROM feat) - y AS g, x FROM feat)"""


def _splits(name: str, rows: str, alpha: float, lam: float, gamma: float, least: int) -> str:
    """A CTE with the best split of each node of ``rows``: node, f, v, gain."""
    def score(g: str, n: str) -> str:
        return f"pow(greatest(abs({g}) - {alpha}, 0), 2) / ({n} + {lam})"
    gain = f"{score('gl', 'nl')} + {score('gt - gl', 'nt - nl')} - {score('gt', 'nt')}"
    return f"""{name} AS (WITH cells AS (SELECT node, f, v, sum(g) AS g, count(*) AS n FROM (SELECT node, g, unnest([0, 1, 2, 3]) AS f, unnest(x) AS v FROM {rows}) GROUP BY ALL),
running AS (SELECT node, f, v, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER (PARTITION BY node, f) AS gt, sum(n) OVER (PARTITION BY node, f) AS nt FROM cells WINDOW w AS (PARTITION BY node, f ORDER BY v)),
scored AS (SELECT node, f, v, {gain} AS gain FROM running WHERE nl >= {least} AND nt - nl >= {least})
SELECT * FROM scored WHERE gain > 0 AND gain >= {gamma} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)"""


def _nodes(parts: list[str], alpha: float, lam: float, step: float) -> str:
    value = f"-sign(g) * greatest(abs(g) - {alpha}, 0) / (n + {lam}) * {step}"
    names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
    return f"""SELECT node AS path, {names}[f + 1] AS feature, v AS threshold, round(gain, 3) AS gain, n AS rows, round({value}, 6) + 0.0 AS value
FROM ({' UNION ALL '.join(parts)})"""


def _by_level(depth: int, alpha: float, lam: float, gamma: float, least: int) -> tuple[str, list[str]]:
    ctes, parts = [_ROWS], []
    for k in range(depth):
        ctes.append(_splits(f"s{k}", f"a{k}", alpha, lam, gamma, least))
        ctes.append(f"a{k + 1} AS (SELECT 2 * node + (x[f + 1] > v)::INT AS node, sample_id, y, g, x FROM a{k} JOIN s{k} USING (node))")
        parts.append(f"SELECT node, sum(g) AS g, count(*) AS n, any_value(f) AS f, any_value(v) AS v, any_value(gain) AS gain FROM a{k} LEFT JOIN s{k} USING (node) GROUP BY node")
    parts.append(f"SELECT node, sum(g), count(*), NULL, NULL, NULL FROM a{depth} GROUP BY node")
    return ", ".join(ctes), parts


def _by_leaf(leaves: int, alpha: float, lam: float, least: int) -> tuple[str, list[str]]:
    ctes, parts = [_ROWS], []
    for k in range(leaves - 1):
        ctes.append(_splits(f"s{k}", f"a{k}", alpha, lam, 0.0, least))
        ctes.append(f"t{k} AS (SELECT * FROM s{k} ORDER BY gain DESC, node LIMIT 1)")
        ctes.append(f"a{k + 1} AS (SELECT CASE WHEN a.node = t.node THEN 2 * a.node + (x[f + 1] > v)::INT ELSE a.node END AS node, sample_id, y, g, x FROM a{k} a, t{k} t)")
        parts.append(f"SELECT node, sum(g) AS g, count(*) AS n, any_value(f) AS f, any_value(v) AS v, any_value(gain) AS gain FROM a{k} JOIN t{k} USING (node) GROUP BY node")
    parts.append(f"SELECT node, sum(g), count(*), NULL, NULL, NULL FROM a{leaves - 1} GROUP BY node")
    return ", ".join(ctes), parts


def _vectors(spark, sf):
    rows = line_features(spark, sf).withColumn("sample_id", F.concat_ws("-", *LINE_KEY)).withColumn("logged", F.log1p("price"))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows).select("sample_id", "logged", "line", "features")


def _tree(spark, sf, **settings):
    """All nodes of the first tree."""
    found = BoostedTrees(labelCol="logged", maxIter=1, **settings).fit(_vectors(spark, sf)).nodes(spark)
    name = F.get(F.array(*map(F.lit, NAMES)), F.col("feature"))
    return found.select("path", name.alias("feature"), "threshold", F.round("gain", 3).alias("gain"), "rows", (F.round("value", 6) + 0.0).alias("value"))


_LEVEL, _LEVEL_PARTS = _by_level(3, 0.5, 0.5, 0.1, 5)
_LEAF, _LEAF_PARTS = _by_leaf(6, 0.5, 0.5, 25)


@query("second_order_tree", f"WITH {_LEVEL} {_nodes(_LEVEL_PARTS, 0.5, 0.5, 0.08)}")
def second_order_tree(spark, sf):
    """A tree grown level by level under L1, L2, a smallest gain and a smallest child: splits, gains and leaf values."""
    return _tree(spark, sf, growth="level", maxDepth=3, stepSize=0.08, regAlpha=0.5, regLambda=0.5, gamma=0.1, minChildWeight=5.0)


@query("leaf_wise_tree", f"WITH {_LEAF} {_nodes(_LEAF_PARTS, 0.5, 0.5, 0.08)}")
def leaf_wise_tree(spark, sf):
    """A tree of six leaves, the best leaf split first."""
    return _tree(spark, sf, growth="leaf", numLeaves=6, maxDepth=0, stepSize=0.08, regAlpha=0.5, regLambda=0.5, minChildRows=25)


# One feature of two values: every tree splits there, and the error after t trees has a closed form.
@query("patience_rounds", f"""
WITH {Q.LINE}, rows AS (SELECT {_SID} AS sample_id, l_linenumber::DOUBLE AS y, l_linenumber > 3 AS side FROM line),
dealt AS (SELECT *, {Q.fold('sample_id', 10, 'validation')} = 0 AS held FROM rows),
base AS (SELECT avg(y) AS b FROM dealt WHERE NOT held), mean AS (SELECT side, avg(y) AS m FROM dealt WHERE NOT held GROUP BY side),
loss AS (SELECT t, avg(pow(y - (b + (m - b) * (1 - pow(1 - 0.3, t))), 2)) AS e FROM range(1, 61) r(t), base, dealt JOIN mean USING (side) WHERE held GROUP BY t),
seen AS (SELECT t, e, max(e) OVER (ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS worst FROM loss)
SELECT t AS kept_trees, round(e, 6) AS loss FROM seen WHERE t > 5 AND e + 0.0001 >= worst ORDER BY t LIMIT 1""")
def patience_rounds(spark, sf):
    """How many trees are kept when five rounds without gain end the boosting, and the held-out error then."""
    rows = _vectors(spark, sf).withColumn("side", (F.col("line") > 3).cast("double")).drop("features")
    rows = VectorAssembler(inputCols=["side"], outputCol="features").transform(rows)
    model = BoostedTrees(labelCol="line", maxIter=60, maxDepth=1, stepSize=0.3, patience=5, tolerance=1e-4).fit(rows)
    return spark.createDataFrame([(len(model.trees), model.losses[-1])], "kept_trees long, loss double").select("kept_trees", F.round("loss", 6).alias("loss"))


_FOREST, _ = _by_level(2, 0.0, 0.0, 0.0, 2)


@query("forest_of_one_tree", f"WITH {_FOREST} SELECT sample_id, round(avg(y) OVER (PARTITION BY node), 6) AS prediction FROM a2")
def forest_of_one_tree(spark, sf):
    """A forest of one tree on all rows and features is the tree of least squares."""
    rows = _vectors(spark, sf)
    one = ModelSpec("rf", "forest", dict(numTrees=1, maxDepth=2, minInstancesPerNode=2, featureSubsetStrategy="all", bootstrap=False, maxBins=64))
    return rounded(apply_model(fit_model(one, rows, "logged"), rows, "prediction"), ["sample_id"], ["prediction"], 6)

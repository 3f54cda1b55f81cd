"""Trees as a table of nodes: DuckDB walks what MLlib fitted, and MLlib scores what a table says."""
import duckdb
import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from talentlens.config import TrainConfig
from talentlens.operators import model, trees
from talentlens.operators.features import FEATURE_COLUMNS
from talentlens.plans import pipeline as PL

WALK = """
WITH RECURSIVE walk AS (
  SELECT id, tree, 0 AS at FROM x, (SELECT DISTINCT tree FROM node)
  UNION ALL SELECT walk.id, walk.tree, CASE WHEN x.f[feature] <= threshold THEN "left" ELSE "right" END
  FROM walk JOIN node ON node.tree = walk.tree AND node.node = walk.at AND feature IS NOT NULL JOIN x ON x.id = walk.id)
SELECT id, sum(weight * value) AS p FROM walk JOIN node ON node.tree = walk.tree AND node.node = walk.at WHERE feature IS NULL GROUP BY id"""


@pytest.fixture(scope="module")
def fitted(spark):
    feats = PL.featurize(PL.flat_candidates(spark, SF001))
    rows = feats.withColumn("llm_score", (F.col("feat_dim2_production_kw_count") + F.col("feat_dim5_years_exp") / 4 + F.crc32("candidate_id") % 3).cast("double"))
    cols = model.usable_columns(rows, FEATURE_COLUMNS)
    return model.fit(rows, cols, TrainConfig(max_iter=25, max_labels=150)), cols, feats.orderBy("candidate_id").limit(200)


def test_duckdb_walks_the_fitted_nodes_to_the_same_prediction(spark, fitted):
    pipe, cols, rows = fitted
    nodes = trees.node_table(pipe, cols)
    assert nodes.dtypes == spark.createDataFrame([], trees.NODE_SCHEMA).dtypes
    got = {r.candidate_id: r.raw_model_score for r in model.score(pipe, rows, cols).collect()}
    x = model.impute(rows, cols).select(F.col("candidate_id").alias("id"), F.create_map(*[a for c in cols for a in (F.lit(c), F.col(f"__x_{c}"))]).alias("f")).toArrow()
    node = nodes.toArrow()  # noqa: F841
    with duckdb.connect() as con:
        con.register("x", x)
        con.register("node", node)
        walked = dict(con.execute(WALK).fetchall())
    assert len({round(v, 6) for v in got.values()}) > 50 and walked == pytest.approx(got, abs=1e-9)


def test_importances_of_the_table_are_those_of_the_model(spark, fitted):
    pipe, cols, _ = fitted
    got = {r.feature: r for r in trees.importances(trees.node_table(pipe, cols), [*cols, "unused"]).collect()}
    assert {f: r.importance for f, r in got.items() if f != "unused"} == pytest.approx(dict(model.importances(pipe, cols)), abs=1e-9)
    assert sum(r.gain_importance for r in got.values()) == pytest.approx(1) and tuple(got["unused"])[1:] == (0.0, 0.0, 0)


def test_round_trip_and_saved_pipeline(spark, fitted):
    pipe, cols, rows = fitted
    nodes = trees.node_table(pipe, cols)
    again = trees.model_from_nodes(nodes.withColumn("tree", F.col("tree") * 10).withColumn("node", F.col("node") * 3)
                                   .withColumn("left", F.col("left") * 3).withColumn("right", F.col("right") * 3), cols)      # numbers with gaps
    path = trees._scratch(spark, "pipe")
    model.save(again, path, cols)
    loaded, columns = model.load(path)
    assert columns == cols
    scores = lambda m: [r.raw_model_score for r in model.score(m, rows, cols).orderBy("candidate_id").collect()]
    assert scores(loaded) == pytest.approx(scores(pipe), abs=1e-12)
    expr = model.impute(model.score(pipe, rows, cols), cols).select((trees.expression(nodes) - F.col("raw_model_score")).alias("d"))
    assert expr.agg(F.max(F.abs("d"))).first()[0] < 1e-9
    data = model.impute(rows, cols)
    covered = {(r.tree, r.node): r.samples for r in trees.cover(nodes, data).collect()}
    for r in nodes.collect():
        assert covered[r.tree, 0] == 200 and (r.left is None or covered[r.tree, r.left] + covered[r.tree, r.right] == covered[r.tree, r.node])


def test_a_table_printed_by_a_boosting_library(spark):
    printed = spark.createDataFrame([
        (0, 0, "0-0", "a", 0.1, "0-1", "0-2", 3.0, 8.0), (0, 1, "0-1", "Leaf", None, None, None, -0.5, 4.0), (0, 2, "0-2", "Leaf", None, None, None, 0.75, 4.0),
        (1, 0, "1-0", "Leaf", None, None, None, 0.125, 8.0)], "Tree int, Node int, ID string, Feature string, Split double, Yes string, No string, Gain double, Cover double")
    nodes = trees.booster_nodes(printed, base_score=0.5)
    split = np.float32(0.1)
    near = [float(split), float(np.nextafter(split, np.float32(0))), 0.1, float(np.nextafter(np.float64(split), 0)), 0.0, 5.0]
    rows = spark.createDataFrame([(i, x, 0.0) for i, x in enumerate(near)], "i int, a double, b double")
    got = [r.raw_model_score for r in model.score(trees.model_from_nodes(nodes, ["a", "b"]), rows, ["a", "b"]).orderBy("i").collect()]
    assert got == [0.5 + (-0.5 if np.float32(x) < split else 0.75) + 0.125 for x in near]


@pytest.mark.parametrize("change,message", [
    ({"feature": "other"}, "not a node"), ({"threshold": None}, "not a node"), ({"right": 1}, "not a node"), ({"value": None}, "not a node"),
    ({"left": 0}, "not a node"), ({"right": 7}, "missing, repeated")])
def test_tables_that_are_no_trees(spark, change, message):
    root = {"tree": 0, "weight": 1.0, "node": 0, "feature": "a", "threshold": 1.0, "left": 1, "right": 2, "value": 0.0, "gain": 1.0, "samples": 2} | change
    rows = [tuple(root.values()), (0, 1.0, 1, None, None, None, None, 1.0, None, 1), (0, 1.0, 2, None, None, None, None, 2.0, None, 1)]
    with pytest.raises(ValueError, match=message):
        trees.check_nodes(spark.createDataFrame(rows, trees.NODE_SCHEMA), ["a"])


def test_no_trees_without_children_or_with_orphans(spark):
    leaf = (0, 1.0, 0, None, None, None, None, 1.0, None, 1)
    trees.check_nodes(spark.createDataFrame([leaf], trees.NODE_SCHEMA), ["a"])
    with pytest.raises(ValueError, match="node 4"):
        trees.check_nodes(spark.createDataFrame([leaf, (*leaf[:2], 4, *leaf[3:])], trees.NODE_SCHEMA), ["a"])

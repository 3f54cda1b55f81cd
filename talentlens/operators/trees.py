"""Boosted trees as a flat table of nodes.

One row is one node: ``tree, weight, node, feature, threshold, left, right, value, gain, samples``.  A split node sends
a row left if its feature is at or below the threshold; a leaf has no feature.  A model predicts the sum of weight x
value over the leaves that a row reaches.

* :func:`node_table` writes out what MLlib fitted, so that any engine can walk it;
* :func:`model_from_nodes` turns such a table into an MLlib model, which scores inside the JVM, so trees fitted
  elsewhere can be used; :func:`booster_nodes` reads the table that boosting libraries print;
* :func:`importances` needs the table alone;
* :func:`expression` is the same prediction as one column expression, for small models and for checks.

The size of a table is that of the model, not of the data.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import checkpoint_dir

NODE_SCHEMA = ("tree int, weight double, node int, feature string, threshold double, left int, right int, value double, "
               "gain double, samples long")

#: A node as MLlib saves it.
_SAVED_NODE = ("struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,"
               "rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def node_table(model: PipelineModel, cols: list[str]) -> DataFrame:
    """The nodes of a fitted pipeline whose inputs are ``cols``, in the order of the assembler."""
    spark = SparkSession.getActiveSession()
    gbt, path = model.stages[-1], _scratch(spark, "trees")
    gbt.write().overwrite().save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(gbt.treeWeights)], "treeID int, weight double")
    n = F.col("nodeData")
    leaf = n.leftChild < 0
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), n.split.featureIndex + 1)
    return spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID").select(       # a row for each tree
        F.col("treeID").alias("tree"), "weight", n.id.alias("node"), F.when(~leaf, name).alias("feature"),
        F.when(~leaf, n.split.leftCategoriesOrThreshold[0]).alias("threshold"), F.when(~leaf, n.leftChild).alias("left"),
        F.when(~leaf, n.rightChild).alias("right"), n.prediction.alias("value"), F.when(~leaf, n.gain).alias("gain"),
        n.rawCount.alias("samples"))


def booster_nodes(printed: DataFrame, base_score: float = 0.5) -> DataFrame:
    """The table that boosting libraries print (``Tree, Node, ID, Feature, Split, Yes, No, Gain, Cover``) as nodes.

    There a row goes to ``Yes`` if its feature is below the split, compared as 32-bit numbers; a leaf is the feature
    ``Leaf`` and holds its value as ``Gain``.  ``base_score`` becomes a tree of one leaf.
    """
    spark = printed.sparkSession
    leaf = F.col("Feature") == "Leaf"
    child = lambda c: F.when(~leaf, F.split_part(F.col(c), F.lit("-"), F.lit(2)).cast("int"))
    nodes = printed.select((F.col("Tree") + 1).cast("int").alias("tree"), F.lit(1.0).alias("weight"), F.col("Node").cast("int").alias("node"),
                           F.when(~leaf, F.col("Feature")).alias("feature"), F.when(~leaf, F.pandas_udf(below, DoubleType())(F.col("Split").cast("float"))).alias("threshold"),
                           child("Yes").alias("left"), child("No").alias("right"),
                           F.when(leaf, F.col("Gain")).otherwise(0.0).cast("double").alias("value"), F.when(~leaf, F.col("Gain").cast("double")).alias("gain"),
                           F.col("Cover").cast("long").alias("samples"))
    base = spark.createDataFrame([(0, 1.0, 0, None, None, None, None, float(base_score), None, 0)], NODE_SCHEMA)
    return base.union(nodes)


def below(split: pd.Series) -> pd.Series:
    """The greatest double that, rounded to 32 bits, is still below the 32-bit ``split``."""
    s = split.to_numpy(np.float32)
    lower = np.nextafter(s, np.float32(-np.inf))
    middle = (lower.astype(np.float64) + s) / 2                    # exact; it rounds to the one of the two that is even
    return pd.Series(np.where(middle.astype(np.float32) == lower, middle, np.nextafter(middle, -np.inf)))


def check_nodes(nodes: DataFrame, cols: list[str]) -> None:
    """Raise if a table isn't a set of trees over ``cols``: unknown features, half a split, a child that is missing, shared or not after its parent."""
    known = F.coalesce(F.col("feature").isin(*cols), F.lit(False)) if cols else F.lit(False)
    leaf = F.col("feature").isNull() & F.col("left").isNull() & F.col("right").isNull() & F.col("threshold").isNull()
    whole = known & F.col("threshold").isNotNull() & (F.col("left") > F.col("node")) & (F.col("right") > F.col("node")) & (F.col("left") != F.col("right"))
    bad = nodes.where(~(leaf | F.coalesce(whole, F.lit(False))) | F.col("value").isNull() | F.col("weight").isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"not a node of a tree over the given features: {bad[0].asDict()}")
    children = nodes.where("left IS NOT NULL").select("tree", F.explode(F.array("left", "right")).alias("node"))
    roots = nodes.groupBy("tree").agg(F.min("node").alias("node"))
    want = children.union(roots).withColumn("c", F.lit(1))
    have = nodes.select("tree", "node", F.lit(-1).alias("c"))
    odd = want.union(have).groupBy("tree", "node").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).where("c <> 0 OR n <> 2").limit(1).collect()
    if odd:
        raise ValueError(f"tree {odd[0].tree}: node {odd[0].node} is missing, repeated, or the child of several nodes or of none")


def model_from_nodes(nodes: DataFrame, cols: list[str]) -> PipelineModel:
    """An MLlib pipeline over the imputed ``cols`` (see ``model.score``) that predicts what the table says."""
    check_nodes(nodes, cols)
    spark, path = nodes.sparkSession, _scratch(spark=nodes.sparkSession, what="trees")
    order = Window.partitionBy("tree").orderBy("node")
    numbered = nodes.withColumn("id", F.row_number().over(order) - 1)
    ids = numbered.select("tree", "node", "id")
    child = lambda side: ids.select("tree", F.col("node").alias(side), F.col("id").alias(f"{side}_id"))
    numbered = numbered.join(child("left"), ["tree", "left"], "left").join(child("right"), ["tree", "right"], "left")
    place = F.coalesce(F.element_at(F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))]), F.col("feature")), F.lit(-1))
    weight = F.coalesce(F.col("samples"), F.lit(0))
    saved = F.struct(
        F.col("id").cast("int").alias("id"), F.col("value").alias("prediction"), F.lit(0.0).alias("impurity"),
        F.array(weight.cast("double"), weight * F.col("value"), F.lit(0.0)).alias("impurityStats"), weight.alias("rawCount"),
        F.coalesce(F.col("gain"), F.lit(-1.0)).alias("gain"), F.coalesce("left_id", F.lit(-1)).alias("leftChild"), F.coalesce("right_id", F.lit(-1)).alias("rightChild"),
        F.struct(place.alias("featureIndex"), F.when(F.col("feature").isNull(), F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split"))
    dense = F.dense_rank().over(Window.orderBy("tree")) - 1                          # over the trees of one model
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight")).withColumn("treeID", dense.cast("int"))
    about = {"timestamp": 0, "sparkVersion": spark.version, "paramMap": {"impurity": "variance"}, "defaultParamMap": {}}
    one = json.dumps(about | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": "tree"})
    n_trees = trees.count()
    whole = json.dumps(about | {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "uid": f"trees_{uuid.uuid4().hex[:12]}",
                                "numFeatures": len(cols), "numTrees": n_trees})
    numbered.join(trees.select("tree", "treeID"), "tree").select("treeID", saved.cast(_SAVED_NODE).alias("nodeData")).write.parquet(f"{path}/data")
    trees.select(F.col("treeID").alias("_1"), F.lit(one).alias("_2"), F.col("weight").alias("_3")).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    assembler = VectorAssembler(inputCols=[f"__x_{c}" for c in cols], outputCol="features", handleInvalid="keep")
    return PipelineModel([assembler, GBTRegressionModel.load(path)])


def importances(nodes: DataFrame, cols: list[str]) -> DataFrame:
    """N7 from the table: for each of ``cols`` the share of gain x samples over all its splits, and the share of its mean gain.

    The first is MLlib's measure, the second the one that boosting libraries report.  Features without a split have 0.
    """
    splits = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("samples")).alias("total"), F.avg("gain").alias("mean"), F.count(F.lit(1)).alias("splits"))
    every = nodes.sparkSession.createDataFrame([(c,) for c in cols], "feature string").join(splits, "feature", "left")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(Window.partitionBy())), F.lit(0.0))  # noqa: E731  (a row for each feature)
    return every.select("feature", share("total").alias("importance"), share("mean").alias("gain_importance"), F.coalesce("splits", F.lit(0)).alias("splits"))


def cover(nodes: DataFrame, rows: DataFrame, prefix: str = "__x_") -> DataFrame:
    """``nodes`` with ``samples`` counted on ``rows`` (imputed columns): how many of them reach each node, in one pass.

    For models of some hundred nodes.  ``importances`` of the result weighs each split by the data at hand instead
    of the rows that the model was fitted on.
    """
    spark, held = nodes.sparkSession, nodes.collect()
    by_place = {(r.tree, r.node): r for r in held}
    reach: dict[tuple, Column] = {}

    def down(tree: int, node: int, path: Column) -> None:
        r = by_place[tree, node]
        reach[tree, node] = F.count(F.when(path, F.lit(1)))
        if r.feature is not None:
            left = F.col(prefix + r.feature) <= F.lit(r.threshold)
            down(tree, r.left, path & left)
            down(tree, r.right, path & ~left)

    for tree in sorted({t for t, _ in by_place}):
        down(tree, min(n for t, n in by_place if t == tree), F.lit(True))
    counted = rows.agg(*[c.alias(f"{t}_{n}") for (t, n), c in reach.items()]).first()
    return spark.createDataFrame([(*r[:-1], counted[f"{r.tree}_{r.node}"]) for r in held], NODE_SCHEMA)


def expression(nodes: DataFrame, prefix: str = "__x_") -> Column:
    """The prediction as one expression over the imputed columns; for models of some hundred nodes."""
    rows = {(r.tree, r.node): r for r in nodes.collect()}

    def of(tree: int, node: int) -> Column:
        r = rows[tree, node]
        return F.lit(r.value) if r.feature is None else F.when(F.col(prefix + r.feature) <= F.lit(r.threshold), of(tree, r.left)).otherwise(of(tree, r.right))

    total = F.lit(0.0)
    for tree in sorted({t for t, _ in rows}):
        root = min(n for t, n in rows if t == tree)
        total = total + F.lit(rows[tree, root].weight) * of(tree, root)
    return total

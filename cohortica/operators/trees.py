"""A fitted tree ensemble as a table of nodes, and rows walked down it by joins."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.session import settle, shared_dir, small_side

NODES = "tree int, node int, feature string, threshold double, left int, right int, value double, weight double"


def ensemble_nodes(model: PipelineModel, feats: Sequence[str]) -> DataFrame:
    """A row per node of a fitted forest or of boosted trees (see NODES); node 0 is a tree's root.

    Rows with ``feature <= threshold`` go to ``left``, others to ``right``; a leaf has neither. ``value`` is
    the share of class 1 at a node of a forest, and the regression value at one of boosted trees;
    ``weight`` is the tree's. The model is saved to the shared folder and its nodes are read from there,
    so they never pass through the driver. Features must be numbers, as the splits are thresholds.
    """
    spark = SparkSession.getActiveSession()
    ensemble = model.stages[-1]
    folder = f"{shared_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    ensemble.write().save(folder)
    weights = spark.read.parquet(f"{folder}/treesMetadata")
    tree, _, weight = weights.columns
    weights = weights.select(F.col(tree).cast("int").alias("tree"), F.col(weight).cast("double").alias("weight"))
    node, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = node["leftChild"] < 0
    if "RandomForest" in type(ensemble).__name__:
        stats = node["impurityStats"]
        value = F.coalesce(stats[1], F.lit(0.0)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    else:
        value = node["prediction"]
    name = F.element_at(F.array(*[F.lit(f) for f in feats]), split["featureIndex"] + 1)
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").cast("int").alias("tree"), node["id"].cast("int").alias("node"),
        F.when(~leaf, name).alias("feature"), F.when(~leaf, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(~leaf, node["leftChild"]).cast("int").alias("left"), F.when(~leaf, node["rightChild"]).cast("int").alias("right"),
        value.alias("value"),
    ).join(F.broadcast(weights), "tree")  # a row per tree


def depth(nodes: DataFrame) -> int:
    """Levels below the roots."""
    level, n = nodes.where("node = 0").select("tree", "node"), 0
    inner = settle(nodes.where("left is not null").select("tree", "node", F.explode(F.array("left", "right")).alias("_child")))
    while True:
        level = settle(level.join(inner, ["tree", "node"]).select("tree", F.col("_child").alias("node")))
        if not level.limit(1).count():
            return n
        n += 1


def walk(rows: DataFrame, nodes: DataFrame, key: str, feats: Sequence[str]) -> DataFrame:
    """``key, tree, node, value, weight``: the leaf that each row reaches in each tree.

    One join with the nodes per level; a row at a leaf stays there. Nodes are sent to every task if
    they are measured to be small. A null feature goes right, as it is not at most the threshold.
    Rows with a null key are walked like others; an empty table reaches no leaf.
    """
    nodes = settle(nodes)
    levels = depth(nodes)
    trees = [r.tree for r in nodes.where("node = 0").select("tree").orderBy("tree").collect()]  # a number per tree
    values = F.map_from_arrays(F.array(*[F.lit(f) for f in feats]), F.array(*[F.col(f"`{f}`").cast("double") for f in feats]))
    at = rows.select(F.col(f"`{key}`").alias(key), values.alias("_x"), F.explode(F.array(*[F.lit(t).cast("int") for t in trees])).alias("tree"), F.lit(0).alias("node"))
    inner = small_side(nodes.where("left is not null").select("tree", "node", "feature", "threshold", "left", "right"))
    for _ in range(levels):
        goes = F.when(F.element_at("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(
            key, "_x", "tree", F.when(F.col("left").isNull(), F.col("node")).otherwise(goes).alias("node")
        )
    ends = small_side(nodes.select("tree", "node", "value", "weight"))
    return at.drop("_x").join(ends, ["tree", "node"]).select(key, "tree", "node", "value", "weight")


def walked_scores(rows: DataFrame, model: PipelineModel, key: str, feats: Sequence[str]) -> DataFrame:
    """``key, score``: the probability of class 1 from the leaves alone, for a unique ``key``."""
    leaves = walk(rows, ensemble_nodes(model, feats), key, feats).groupBy(key)
    if "RandomForest" in type(model.stages[-1]).__name__:
        return leaves.agg(F.avg("value").alias("score"))
    return leaves.agg((1 / (1 + F.exp(-2 * F.sum(F.col("value") * F.col("weight"))))).alias("score"))

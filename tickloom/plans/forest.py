"""A fitted forest as a table of nodes, and its scores as joins.

Rows go down the trees level by level: a row stands at one node of every tree, and a join with the node table says where it goes
next. It is how a forest can be scored and looked into with SQL alone, and it checks what ``spark.ml`` predicts by another way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans.features import FEATURE_COLUMNS


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """``tree, node, is_leaf, feature, threshold, below, above, stats`` of a saved pipeline with a forest of continuous features:
    values up to the threshold go ``below``; ``stats`` are the weights of the classes at the node."""
    saved = spark.read.parquet(f"{path}/stages/*RandomForestClassifier*/data")
    node = F.col("nodeData")
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        (node["leftChild"] < 0).alias("is_leaf"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("below"),
        node["rightChild"].alias("above"),
        node["impurityStats"].alias("stats"),
    )


def depth(model: PipelineModel) -> int:
    return max(tree.depth for tree in model.stages[-1].trees)


def probabilities(rows: DataFrame, forest: DataFrame, levels: int, keys: Sequence[str] = ("symbol", "window_start")) -> DataFrame:
    """``keys, probability, prediction``: the mean over the trees of the share of class one at the leaf a row comes to. ``keys`` have to
    name a row; ``forest`` has as many rows as the forest has nodes, and how it is joined is the planner's choice."""
    values = F.array(*(F.col(c).cast("double") for c in FEATURE_COLUMNS))
    trees = forest.where(F.col("node") == 0).agg(F.sort_array(F.collect_list("tree"))).first()[0]
    at = rows.select(*keys, values.alias("values"), F.explode(F.array(*(F.lit(t) for t in trees))).alias("tree"))
    at = at.withColumn("node", F.lit(0))
    for _ in range(levels):
        here = at.join(forest.drop("stats"), ["tree", "node"])
        goes = F.when(F.col("is_leaf"), F.col("node")).when(
            F.get("values", F.col("feature")) <= F.col("threshold"), F.col("below")
        ).otherwise(F.col("above"))
        at = here.select(*keys, "values", "tree", goes.alias("node"))
    leaves = at.join(forest.select("tree", "node", "stats"), ["tree", "node"])
    share = F.get("stats", F.lit(1)) / F.aggregate("stats", F.lit(0.0), lambda total, x: total + x)
    out = leaves.groupBy(*keys).agg(F.avg(share).alias("probability"))
    return out.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

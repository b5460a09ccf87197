"""A fitted forest as tables, and scores from the tables alone.

``ForestNodes`` has a row per node of every tree: the split of an inner node and
where it leads, or the share of churned customers of a leaf.  ``ForestInputs``
has the features in the order of their numbers, with the shift and scale that
splits refer to.  Any SQL engine can score with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.schemas import FOREST_INPUTS, FOREST_NODES


def forest_nodes(spark: SparkSession, saved_model: str) -> DataFrame:
    """Nodes of the forest in a saved pipeline.  A leaf has no feature; its share is that of churned customers."""
    node = F.col("nodeData")
    stats = F.col("nodeData.impurityStats")
    churned = F.coalesce(F.get(stats, F.lit(1)), F.lit(0.0))
    seen = F.aggregate(stats, F.lit(0.0), lambda total, x: total + x)
    is_leaf = node.leftChild < 0
    inner = lambda column: F.when(~is_leaf, column)
    return spark.read.parquet(f"{saved_model}/stages/*_RandomForestClassifier_*/data").select(
        F.col("treeID").alias("Tree"),
        node.id.alias("Node"),
        inner(node.split.featureIndex).alias("Feature"),
        inner(F.get(node.split.leftCategoriesOrThreshold, F.lit(0))).alias("Threshold"),
        inner(node.leftChild).alias("LeftNode"),
        inner(node.rightChild).alias("RightNode"),
        F.when(is_leaf, F.coalesce(F.try_divide(churned, seen), F.lit(0.0))).alias("ChurnShare"),
    )


def forest_inputs(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Features by number, with what the model subtracts from a value and multiplies the difference by."""
    names, scaler = model.stages[0].getInputCols(), model.stages[1]
    rows = [(i, name, float(m), 1.0 / float(s) if s else 0.0) for i, (name, m, s) in enumerate(zip(names, scaler.mean, scaler.std, strict=True))]
    return spark.createDataFrame(rows, FOREST_INPUTS)


def save_tables(spark: SparkSession, model: PipelineModel, path: str) -> None:
    """Write both tables next to the model saved under ``path``."""
    forest_nodes(spark, f"{path}/model").write.mode("overwrite").parquet(f"{path}/nodes")
    forest_inputs(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")


def load_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.schema(FOREST_NODES).parquet(f"{path}/nodes"), spark.read.schema(FOREST_INPUTS).parquet(f"{path}/inputs")


def probabilities(prepared: DataFrame, nodes: DataFrame, inputs: DataFrame, depth: int) -> DataFrame:
    """CustomerID and Probability: the mean churn share of the leaves that a customer's features lead to.

    A customer starts at the root of every tree and goes down one level per
    join.  The nodes are broadcast: trees and ``depth``, which no tree exceeds,
    bound them, whatever the number of customers.  So all levels and the first
    part of the sum are one stage, and one narrow row per customer is shuffled.
    """
    numbered = inputs.orderBy("Feature").collect()  # one row per feature
    scaled = F.array(*[(F.col(r["Name"]) - F.lit(r["Shift"])) * F.lit(r["Scale"]) for r in numbered])
    place = (F.col("Tree").cast("long") * (1 << 32) + F.col("Node")).alias("Place")
    first = F.col("Tree").cast("long") * (1 << 32)
    inner = nodes.filter("Feature is not null").select(
        place, "Feature", "Threshold", (first + F.col("LeftNode")).alias("LeftPlace"), (first + F.col("RightNode")).alias("RightPlace")
    )
    leaves = nodes.filter("Feature is null").select(place, "ChurnShare")
    trees = nodes.agg(F.max("Tree")).first()[0]
    walk = prepared.select("CustomerID", scaled.alias("Inputs"), F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("Tree")).select("CustomerID", "Inputs", first.alias("Place"))
    below = F.when(F.col("Feature").isNull(), F.col("Place")).when(F.get("Inputs", "Feature") <= F.col("Threshold"), F.col("LeftPlace"))
    for _ in range(depth):
        walk = walk.join(F.broadcast(inner), "Place", "left").select("CustomerID", "Inputs", below.otherwise(F.col("RightPlace")).alias("Place"))
    return walk.join(F.broadcast(leaves), "Place").groupBy("CustomerID").agg((F.sum("ChurnShare") / (trees + 1)).alias("Probability"))


def score(prepared: DataFrame, nodes: DataFrame, inputs: DataFrame, depth: int, as_of: dt.date) -> DataFrame:
    """Churn probability of every row to four places, as ``churn_model.score`` gives it."""
    return probabilities(prepared, nodes, inputs, depth).select(
        "CustomerID",
        F.round("Probability", 4).cast("decimal(5,4)").alias("ChurnProbability"),
        F.lit(as_of).alias("ScoredDate"),
    )

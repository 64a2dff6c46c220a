"""A trained forest as rows, for those who check or serve its scores elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from undercut.sources.files import Files


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved forest: (tree, node, feature, split, left, right, no, yes).

    Node 0 is the root of its tree. A reading up to ``split`` goes left. A leaf has feature
    -1; ``no`` and ``yes`` are the weights of the training rows of either label that reached it.
    """
    (stage,) = (name for name in Files(spark, path).children(f"{path}/stages") if name.startswith("1_"))
    saved = spark.read.parquet(f"{path}/stages/{stage}/data")
    node = F.col("nodeData")
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("split"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        F.get(node["impurityStats"], F.lit(0)).alias("no"),
        F.get(node["impurityStats"], F.lit(1)).alias("yes"),
    )

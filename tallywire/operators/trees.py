"""A fitted ensemble as a table of nodes, and the walk through its trees.

The table is what the model saves: one row per node. With it a prediction can be recomputed, explained or compared by
plain table operations, in Spark or elsewhere, without the ML library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.session import scratch_path


def node_table(model: PipelineModel | GBTClassificationModel) -> DataFrame:
    """tree, weight, node, feature, threshold, left, right, prediction, rows. Leaves have no feature and no children.

    Nodes of a tree are numbered from the root, 0, without gaps. The size is that of the model, whatever it was fitted on.
    """
    trees = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = SparkSession.active()
    path = scratch_path(spark, "ensemble")
    trees.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_about", "weight").select("tree", "weight")
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    nodes = saved.select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("prediction"),
        n["rawCount"].alias("rows"),
        F.when(inner, n["split"]["numCategories"]).alias("_categories"),
    )
    if nodes.where("_categories >= 0").limit(1).count():
        raise ValueError("splits on categories are not walked")
    return nodes.drop("_categories").join(weights, "tree").select("tree", "weight", "node", "feature", "threshold", "left", "right", "prediction", "rows")


def _walk(nodes: DataFrame, depth: int) -> tuple[Callable, int]:
    """Arrow function from a column of feature arrays to the weighted sum over the trees of the leaf that a row reaches, and how many features
    it looks at. Only the model passes through the driver, 2 ** (depth + 1) nodes a tree at most.

    The function is a closure, so that it goes to the tasks by value and executors need numpy and pyarrow only.
    """
    import numpy as np

    trees: dict[int, list] = {}
    for row in nodes.select("tree", "weight", "node", "feature", "threshold", "left", "right", "prediction").orderBy("tree", "node").collect():
        trees.setdefault(row["tree"], []).append(row)
    forest = []
    for rows in trees.values():
        # a leaf is its own child, so rows that have arrived stay
        own = [(0, 0.0, r["node"], r["node"]) if r["left"] is None else (r["feature"], r["threshold"], r["left"], r["right"]) for r in rows]
        feature, threshold, left, right = (np.array(x) for x in zip(*own))
        # both children of a node side by side: 2 * node + 1 is the left one
        children = np.stack([right, left], axis=1).ravel()
        forest.append((rows[0]["weight"], feature, threshold, children, np.array([r["prediction"] for r in rows])))
    width = 1 + max((int(f.max()) for _, f, _, _, _ in forest), default=0)

    def margin(arrays):
        import numpy as np
        import pyarrow as pa

        n = len(arrays)
        x, at_0 = np.asarray(arrays.flatten()), np.asarray(arrays.offsets)
        start = (at_0[:n] - at_0[0]).astype(np.int64)
        total = np.zeros(n)
        for weight, feature, threshold, children, prediction in forest:
            at = np.zeros(n, dtype=np.int64)
            for _ in range(depth):
                at = children[2 * at + (x[start + feature[at]] <= threshold[at])]
            total += weight * prediction[at]
        return pa.array(total)

    return margin, width


def walked(assembled: DataFrame, nodes: DataFrame, depth: int, col: str = "features") -> DataFrame:
    """`assembled` with walk_prob_1 and walk_prediction, as the ensemble's own scoring gives them."""
    walk, width = _walk(nodes, depth)
    # comparisons with a null vector fail, like those with NaN
    features = F.coalesce(vector_to_array(col), F.array_repeat(F.lit(float("nan")), width))
    rows = assembled.withColumn("_margin", F.arrow_udf(walk, "double")(features))
    # the margin is half the log odds
    prob = 1 / (1 + F.exp(-2 * F.col("_margin")))
    return rows.withColumns({"walk_prob_1": prob, "walk_prediction": (F.col("_margin") > 0).cast("int")}).drop("_margin")

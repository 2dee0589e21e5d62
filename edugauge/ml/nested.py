"""One deep forest in the place of many: scores of its smaller and shallower forests.

The trees of a forest are drawn independently, so the first n of them are a forest of n trees. A split is chosen without
regard to the depth limit, so a tree that stops at depth d is the deep tree cut there, with the class counts of the nodes at the
cut. MLlib then folds sibling leaves of equal prediction into their parent, from the leaves up; the same is done after the cut.

Rows are sent down the deep trees once. A table of leaves holds the probability that each cut gives a row of that leaf, and one
join and one aggregate give the scores of all (trees, depth) pairs. A fit with these parameters would draw other random
numbers, as it would with another seed: scores agree with direct fits as forests of two seeds do, not digit by digit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.ml.forest import GrownForest
from edugauge.session import scratch_path, ship_code

#: Leaves that are broadcast at most; beyond, rows and leaves meet in a shuffle.
BROADCAST_LEAVES = 500_000


def cut_tree(left: np.ndarray, right: np.ndarray, prediction: np.ndarray, depth: int) -> np.ndarray:
    """For each node of a tree in pre-order the node that a row there ends in, if the tree stops at ``depth`` (-1 above that)."""
    nodes = len(left)
    level = np.zeros(nodes, np.int64)
    for i in range(nodes):
        if left[i] >= 0:
            level[left[i]] = level[right[i]] = level[i] + 1
    ends = (left < 0) | (level >= depth)
    for i in range(nodes - 1, -1, -1):
        if not ends[i] and ends[left[i]] and ends[right[i]] and prediction[left[i]] == prediction[right[i]]:
            ends[i] = True
    owner = np.where(ends, np.arange(nodes), -1)
    for i in range(nodes):  # a parent comes before its children
        if owner[i] >= 0 and left[i] >= 0:
            owner[left[i]] = owner[right[i]] = owner[i]
    return owner


def leaf_table(model: RandomForestClassificationModel, depths: Sequence[int], spark) -> DataFrame:
    """``tree, leaf, p0, p1, ...``: the probability of label 1 for rows of a leaf, by the depth a tree stops at."""
    ship_code(spark)
    path = scratch_path(spark, "forest")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.prediction",
        (F.get("nodeData.impurityStats", F.lit(1)) / F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, x: a + x)).alias("p"),
    )

    def cut(tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.sort_values("id")
        left, right, prediction, p = (tree[c].to_numpy() for c in ("leftChild", "rightChild", "prediction", "p"))
        leaves = np.flatnonzero(left < 0)
        columns = {f"p{i}": p[cut_tree(left, right, prediction, depth)[leaves]] for i, depth in enumerate(depths)}
        return pd.DataFrame({"tree": tree["tree"].iloc[0], "leaf": np.arange(len(leaves)), **columns})

    return nodes.groupBy("tree").applyInPandas(cut, "tree int, leaf int, " + ", ".join(f"p{i} double" for i in range(len(depths))))


def nested_scores(model: RandomForestClassificationModel | GrownForest, rows: DataFrame, cuts: Sequence[tuple[int, int]]) -> DataFrame:
    """``label, s0, s1, ...``: for each row of ``rows`` (``features``, ``label``) the score by the first ``trees`` trees, stopped at
    ``depth``, for each of ``cuts``.
    """
    if isinstance(model, GrownForest):
        scored = rows.select("label", model.scores(rows.sparkSession, "features", cuts).alias("_scores"))
        return scored.select("label", *[F.get("_scores", F.lit(i)).alias(f"s{i}") for i in range(len(cuts))])
    depths = sorted({depth for _, depth in cuts})
    leaves = leaf_table(model, depths, rows.sparkSession)
    if model.totalNumNodes // 2 <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), "features", "label")
    placed = model.copy().setLeafCol("_leaves").transform(numbered)
    met = placed.select("_row", "label", F.posexplode(vector_to_array("_leaves")).alias("tree", "_leaf"))
    joined = met.withColumn("leaf", F.col("_leaf").cast("int")).join(leaves, ["tree", "leaf"])
    scores = [(F.sum(F.when(F.col("tree") < trees, F.col(f"p{depths.index(depth)}"))) / trees).alias(f"s{i}") for i, (trees, depth) in enumerate(cuts)]
    return joined.groupBy("_row", "label").agg(*scores).drop("_row")

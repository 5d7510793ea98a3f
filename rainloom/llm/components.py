"""Connected components of a large graph by alternating star operations on DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rainloom.session import materialize


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) that connect what the given edges connect."""
    nodes, index = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = index[:len(u)], index[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(lowest, "u").select(
        F.explode(F.array(F.struct(F.col("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
    return moved.select("e.*").where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (u, v): root is the component's smallest node.

    Every round is written to shared storage, so lineage stays short. Rounds end when the edges no
    longer change; each then joins a node to its root. No edges give no rows.
    """
    now = materialize(edges.where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = materialize(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

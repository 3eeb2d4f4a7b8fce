"""Connected components by repeated contraction, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``u, v``); label is its component's smallest node.

    Each step sends every node to the smallest node among itself and its
    neighbours and keeps the edges between the images, so components shrink by
    half or more. Labels are composed of the steps' maps. Edges and maps are
    stored tables; a node with very many edges is split by Spark's skew join.
    """
    edges = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).select("u", "m"), "step")
        if labels is None:
            labels = step.select(F.col("u").alias("node"), F.col("m").alias("label"))
        else:
            labels = labels.join(step, labels["label"] == step["u"], "left").select("node", F.coalesce("m", "label").alias("label"))
        labels = materialise(labels, "labels")
        right = step.select(F.col("u").alias("v"), F.col("m").alias("mv"))
        moved = edges.join(step, "u").select("v", F.col("m").alias("mu")).join(right, "v").select(F.col("mu").alias("u"), F.col("mv").alias("v"))
        moved = moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        edges = materialise(moved, "edges")
    if labels is None:
        labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels


def merge_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, label`` after more ``edges`` (``u, v``) between nodes, labelled so far or not."""
    left = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
    right = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
    between = edges.select("u", "v").join(left, "u", "left").join(right, "v", "left")
    between = between.select(F.coalesce("lu", "u").alias("u"), F.coalesce("lv", "v").alias("v"))
    moved = connected_components(between).select(F.col("node").alias("from"), F.col("label").alias("to"))
    # labels of components that were merged, and nodes that had no label so far
    old = labels.join(moved, labels["label"] == moved["from"], "left").select("node", F.coalesce("to", "label").alias("label"))
    new = moved.join(labels.select(F.col("node").alias("from")), "from", "left_anti").select(F.col("from").alias("node"), F.col("to").alias("label"))
    return materialise(old.unionByName(new), "labels")

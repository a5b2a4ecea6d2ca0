"""Connected components over a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved


def _links(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links, larger end first, without loops."""
    return (
        df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest neighbour (or the node itself)."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    tied = both.join(lowest, F.col("u") == F.col("node")).filter("v > u")
    return _links(tied.select("v", F.least("node", "m").alias("m")), "v", "m")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    lowest = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    tied = links.join(lowest, F.col("u") == F.col("node"))
    moved = tied.filter("v > m").select(F.col("v").alias("a"), "m")
    return _links(moved.unionByName(lowest.select(F.col("node").alias("a"), "m")), "a", "m")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the component's smallest node.

    `links` holds pairs of numbers without nulls. Each round is written to the checkpoint folder;
    rounds end when a round changes nothing, after about log2(links) of them.
    """
    now = saved(_links(links, a, b))
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = saved(_small_star(_large_star(now)))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def spanning(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """For each row the smallest row it reaches by the pairs."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new

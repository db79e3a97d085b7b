"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sarraf.llm.common import compact, discard, stored


def _written(edges: DataFrame, n: int) -> DataFrame:
    """A round over few links is few tasks, however many partitions shuffles have."""
    return stored(compact(edges, n), "component-edges")


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """Connect the neighbours of each node to the smallest of them: its larger ones, or the smaller ones and itself."""
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    near = ends.union(ends.select("v", "u")) if large else ends
    joined = near.join(near.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")), F.col("u") == F.col("_u"))
    if large:
        pairs = joined.filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("a"), F.least("u", "_m").alias("b")
        )
    else:
        pairs = joined.select(F.explode(F.array(
            F.struct(F.col("u").alias("a"), F.col("_m").alias("b")),
            F.struct(F.col("v").alias("a"), F.col("_m").alias("b")),
        )).alias("_e")).select("_e.a", "_e.b")
    return _written(pairs.filter("a <> b").groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_"), n)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), where the component is its smallest node.

    Each round sums per node in the map tasks, so a node with very many links
    is as cheap as the number of its links; paths shrink by doubling.  Links
    are written after each half round, and only their count and a checksum
    reach the driver.
    """
    links = edges.select("a", "b").filter("a <> b")
    n, before = links.count(), None
    now = _written(links.distinct(), n)
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, n = tuple(state), state[0]
        for large in (True, False):
            last, now = now, _star(now, large, 2 * n)
            discard(last)


def smallest_reachable(links: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Smallest name in the component of each node of a small graph, given as a matrix of links."""
    label = names.copy()
    while True:
        near = np.where(links, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(label, near)
        if (new == label).all():
            return label
        label = new

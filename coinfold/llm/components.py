"""Connected components: by numpy within a task, by star contraction across the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinfold.llm.common import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b reduced to one link from each node to the least node of its component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        after = root.copy()
        np.minimum.at(after, root[u], low)
        np.minimum.at(after, root[v], low)
        while not np.array_equal(jumped := after[after], after):
            after = jumped
        if np.array_equal(after, root):
            break
        root = after
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, first: str, second: str) -> DataFrame:
    """node, root: each node that has a link, with the least node reachable from it.

    Alternates large stars (every node links its larger neighbours to its least one) and
    small stars (every node links its smaller neighbours to the least of them) until no
    link changes, which takes a number of rounds logarithmic in the longest path. Every
    step is a partial minimum and a join on the node; a node with very many links is one
    key of the join's larger side only, which adaptive execution splits. A null node has
    no links.
    """
    a, b = F.col(first), F.col(second)
    edges = staged(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        edges = staged(small, "links")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

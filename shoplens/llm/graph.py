"""Connected components of an edge table, by joins and partial aggregates alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import few, written


def components(edges: DataFrame, most_rounds: int = 100, most_edges: int | None = None) -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node of its component.

    Alternates the large-star and the small-star step: neighbours hook to the smallest node known,
    which halves distances, so rounds grow with the logarithm of the longest chain. Each round is a
    written table, in few files while there are few edges; ``most_edges`` bounds those of the first, if known. Hubs are
    split by AQE, as each step is a partial aggregate and a join.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs, mark = _stored(pairs if most_edges is None else few(pairs, most_edges))
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        hooked = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(hooked, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(hooked.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        # A round leaves at most one edge per node and one per edge that it moves.
        pairs, now = _stored(few(small, 2 * mark[0]))
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return few(pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), 2 * mark[0])


def _stored(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    stored = written(pairs, "edges")
    check = stored.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return stored, tuple(check)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node) that connect what the given edges of one task connect."""
    if not len(a):
        return a, b
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[x], parent[y])
        new = parent.copy()
        for side in (parent[x], parent[y], x, y):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, parent):
            break
        parent = new
    child = parent != np.arange(len(nodes))
    return nodes[child], nodes[parent[child]]

"""Connected components of an undirected edge table, by alternating large and small stars.

Both stars are a grouped minimum and an equi-join, so a node with very many
neighbours is pre-aggregated before its shuffle and its join can be split by AQE;
no neighbourhood is ever gathered in one place. Every round is written to the
shared scratch folder, and the round before it removed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.storage import cut_at
from tidefeed.sources.scratch import remove


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of any orderable type to ``(node, root)``: the smallest node reachable.

    Null ends, self loops and repeated edges are ignored; an empty table gives an
    empty table. Nodes without an edge aren't in the result.
    """
    seen = None
    now, path = cut_at(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == seen or not row[0]:
            break
        seen = tuple(row)
        after, new = cut_at(_small_star(_large_star(now)), "edges")
        remove(edges.sparkSession, path)
        now, path = after, new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge, in place, the classes of ``a[i]`` and ``b[i]``; a class is labelled by its smallest index."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up

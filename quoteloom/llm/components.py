"""Connected components of a graph given as edges, by alternating star contraction.

Each round hangs every node on the smallest node it knows; both directions of an edge take turns, which needs a
number of rounds that grows with the logarithm of the graph's size. Every round is written to the shared folder,
so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.session import stage


def _hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    # The minima are written first: then both join sides are plain exchanges, and a node that very many edges
    # share can be split among tasks.
    return edges.join(stage(least, "least"), "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``edges`` (columns ``u``, ``v``); component: its smallest node.

    Repeated edges and loops are harmless; NULL ends are left out. No edges give no rows.
    """
    known = edges.where("u IS NOT NULL AND v IS NOT NULL")
    now = known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, mark = stage(now, "edges"), None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _hung(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _hung(large, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v")
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        now = stage(small, "small-star")
        before, mark = mark, now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
    loops = known.where("u = v").select("u", "v")
    nodes = now.select("u", "v").union(now.select("v", "v")).union(loops)
    return nodes.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))

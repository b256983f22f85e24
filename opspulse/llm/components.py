"""Connected components of an edge table by repeated contraction, without hot groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is a node of the component.

    Each round points every node at the least node among its neighbours and itself and
    then merges along the pointers; a component of diameter d needs about log d rounds.
    The edges shrink from round to round and are written after each. Grouping is by partial aggregates, and the joins read written tables, so
    that a node with very many edges is split among tasks. Null nodes are dropped.
    """
    own = edges.where(f"{a} <> {b}").select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()
    own = scratch.write(own)
    roots = None
    while True:
        both = own.select("u", "v").union(own.select(F.col("v"), F.col("u")))
        parent = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("p"))
        parent = parent.select("node", F.least("node", "p").alias("p"))
        if roots is None:
            roots = parent.select("node", F.col("p").alias("root"))
        else:
            step = parent.select(F.col("node").alias("root"), F.col("p").alias("next"))
            roots = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots = scratch.write(roots)
        pu = parent.withColumnsRenamed({"node": "u", "p": "pu"})
        pv = parent.withColumnsRenamed({"node": "v", "p": "pv"})
        merged = own.join(pu, "u").join(pv, "v").where("pu <> pv")
        own = scratch.write(merged.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        if own.isEmpty():
            return roots

"""Connected components by contraction: every node goes to its least neighbour, then edges join what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the least node its component was contracted to, of every node that has an edge.

    Each round writes its tables to the shared folder, so lineage stays short; the number of rounds
    grows with the logarithm of the largest component, and no component meets in one task.
    """
    left = materialize(_unlike(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    roots = None
    while True:
        both = left.union(left.select("b", "a"))
        nearest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        next_hop = nearest.select(F.col("a").alias("to"), F.col("to").alias("further"))
        hops = nearest.join(next_hop, "to").select("a", F.col("further").alias("to"))
        hops = materialize(hops, "hops")
        if roots is None:
            roots = hops.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = hops.select(F.col("a").alias("root"), "to")
            roots = materialize(roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        by_a, by_b = (hops.select(F.col("a").alias(x), F.col("to").alias(f"{x}_to")) for x in ("a", "b"))
        left = left.join(by_a, "a").join(by_b, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        left = materialize(_unlike(left), "edges")
        if left.isEmpty():
            return roots


def _unlike(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

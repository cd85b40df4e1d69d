"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.session import cut_lineage


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: every neighbour of a node is linked to the node's smallest neighbour instead.

    The large star links the larger neighbours, the small star the smaller ones and the node itself. The minimum is
    combined before the shuffle and joined back, so a node with very many links is split like any skewed join key.
    """
    if small:
        links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        links = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = links.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    joined = links.join(smallest, "u")
    if small:
        out = joined.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("_m").alias("v")),
            F.struct(F.col("u"), F.col("_m").alias("v")),
        )).alias("e")).select("e.*")
    else:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return out.filter("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); the root is the smallest node of the component.

    Alternating large and small stars (Kiveris et al., 2014) until nothing changes; the number of rounds grows with
    the logarithm of the longest chain. Every round is a reliable checkpoint. Nodes without an edge are not in the
    result; an empty table gives an empty result; loops and repeated edges don't matter.
    """
    current = cut_lineage(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        # u > v everywhere, and roots are never a u once all edges are stars
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        current = cut_lineage(_stars(_stars(current, small=False), small=True))
    members = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(members.select(F.col("root").alias("node"), "root").distinct())

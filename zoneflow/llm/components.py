"""Connected components of a graph given as edges, as a series of joins.

Alternates two steps until nothing changes: every node links its larger neighbours to the smallest node it sees, then its
smaller ones and itself. The edges end as stars around each component's smallest node, after a number of rounds
that grows with the logarithm of the graph. Minima are combined before the shuffle, and the joins back are plain
equi-joins, which adaptive execution splits where one node has very many edges. Every round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.session import materialize


def _linked(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """pairs (u, v): links v, or with ``larger_only`` those v above u, to the smallest of u and its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = pairs.join(least, "u")
    if larger_only:
        joined = joined.filter(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    ``edges`` has columns a and b. Edges with a NULL end and loops are ignored; repeated edges count once.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _linked(both, larger_only=True)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        small = _linked(down, larger_only=False).unionAll(
            down.groupBy("u").agg(F.min("v").alias("b")).select(F.col("u").alias("a"), "b"))
        edges = materialize(small.distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)

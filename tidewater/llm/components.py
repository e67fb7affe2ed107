"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge to another; the component
    is its smallest node.

    Alternating large-star and small-star steps: each node's neighbours are
    linked to the smallest of them.  A step is a partial aggregation by node
    and a join back, so a node with very many neighbours is combined before
    the shuffle and its join split by adaptive execution; the number of edges
    does not grow, and the number of steps is logarithmic in the nodes.  Each
    round is written, so a lost executor repeats one round at most."""
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
                  "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, both.filter("v > u"))
        small = _to_least(large, large)
        now = written(small, "edges")
        # the same set of edges as before?  Its size and sums of hashes tell.
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                      F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _to_least(neighbours: DataFrame, linked: DataFrame) -> DataFrame:
    """Edges (greater, smaller) from each node's neighbours in ``linked``, and
    from the node itself, to the least of the node and all its neighbours."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("at"), F.least("u", "m").alias("m"))
    joined = linked.join(least, linked["u"] == least["at"])
    pairs = joined.select("v", "m").unionByName(least.select(F.col("at").alias("v"), "m"))
    return pairs.filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).distinct()

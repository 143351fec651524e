"""Connected components by alternating stars, on links given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, discard

MOST_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reachable.

    In a round every node's larger neighbours are tied to its smallest one, then its smaller neighbours
    likewise. Both need a minimum per node, summed before the shuffle, and a join that adaptive execution
    splits where a node has very many neighbours; no neighbourhood is gathered. Rounds grow with the
    logarithm of the longest chain, and each removes what the one before wrote. Self links only name a node. Null
    ends are ignored.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    named = links.where("a = b").select(F.col("a").alias("id"))
    edges = cut(links.where("a < b").distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = cut(large, "large")
        lower = cut(large.groupBy("b").agg(F.min("a").alias("m")), "lower")
        small = large.join(lower, "b")
        old = (edges, least, large, lower)
        edges = cut(
            small.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b").unionByName(small.select(F.col("m").alias("a"), "b")).distinct(),
            "edges",
        )
        discard(*old)
        now = edges.agg(F.count("*"), F.sum("a"), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    members = edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("id")).unionByName(named).distinct()
    return members.unionByName(roots.join(members, "id", "left_anti").select("id", F.col("id").alias("component")))

"""Connected components by alternating large-star and small-star steps.

Every step is a partial aggregate for each node's smallest neighbour and a join, in which the large-star step
broadcasts nodes with very many links, so none of them sits in one task. Each round is cut to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_narrow, spread_join


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links -> (node, root), root the smallest node reachable; every node of a link is there.

    Loops, repeated links, either direction and null ends (dropped) are accepted.
    """
    e = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both, total = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))), 2 * mark[0]
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = spread_join(both, low, ["a"], "n", total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # here a node is linked to the smallest nodes of its neighbours only, so none has many links
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low2, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low2.select("a", F.col("m").alias("b"))).distinct()
        )
        e = cut_narrow(small, total)
        before, mark = mark, _mark(e)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

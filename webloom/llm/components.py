"""Connected components of a table of links, by Spark joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.storage import BROADCAST_ROWS, stored
from webloom.session import Lookup, lookup_join


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component is named by its least node.

    Alternates two rewirings until nothing changes: every node links its larger neighbours to
    the least of its neighbourhood, then itself and its smaller ones to it. The number of
    links never grows, and rounds grow with the logarithm of a component's size. The least of each node is found by
    partial sums. Links meet it where they lie, if there are few enough nodes to broadcast; if not, in a join that deals the
    links of a node with very many over several tasks. Each round is a stored table, so a lost executor does not
    stop it. Nulls and self links are left out.
    """
    one, two = F.col(a), F.col(b)
    edges = stored(
        links.filter(one != two).select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v")).distinct()
    )
    before = _state(edges)

    def with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
        # a link has two nodes, so the links counted bound the nodes
        if 2 * before[0] <= broadcast_rows:
            return rows.join(F.broadcast(least), "u")
        return lookup_join(rows, Lookup(stored(least), False), "u").filter("m IS NOT NULL")

    for _ in range(most_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = with_least(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = with_least(large, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

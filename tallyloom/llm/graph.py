"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, dealt_join, discard

MOST_ROUNDS = 40


def _stars(edges: DataFrame, least: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """edges with the least neighbour (m) of u, and the table of these; the edges of hubs are dealt out."""
    least = cut(least, "stars")
    return dealt_join(edges, least.drop("n"), "u", least.select("u", "n"), ["v"], total=total), least


def large_star(edges: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Every neighbour larger than a node is joined to the smallest among the node and its neighbours; rows may repeat."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    met, least = _stars(both, least, 2 * total)
    return met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), least


def small_star(edges: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """A node (u) and its smaller neighbours (v) are joined to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    met, least = _stars(edges, least, total)
    turned = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), least


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (a, b: bigint) but the roots; the root is its component's smallest node.

    Each step's table takes the place of the one before it, which is removed.
    """
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def step(star, edges: DataFrame, total: int) -> DataFrame:
        told, least = star(edges, total)
        done = cut(told, "edges")
        discard(edges)
        discard(least)
        return done

    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = sign(edges)
    for _ in range(MOST_ROUNDS):
        edges = step(small_star, step(large_star, edges, mark[0]), mark[0])
        now = sign(edges)
        if mark == now:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

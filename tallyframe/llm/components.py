"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _kept(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict]:
    """edges, kept, with their number and an order-free checksum."""
    return scratch.measured(edges, n=F.count(F.lit(1)), checksum=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every node of edges (a, b), a > b: component is the smallest id reachable.

    A node's neighbours are never gathered: both steps are a combinable minimum
    and a join with one row per node, so adaptive execution can split the rows
    of a node with many neighbours. Each round is written to the shared folder,
    and the previous one deleted. No edges give no rows.
    """
    edges, state = _kept(edges.select("a", "b").distinct(), scratch)
    while state["n"]:
        step, after = _kept(_small_star(_large_star(edges)), scratch)
        scratch.drop(edges)
        edges, before, state = step, state, after
        if state == before:
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)

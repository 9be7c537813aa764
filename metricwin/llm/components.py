"""Connected components by alternating large and small stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import few_or_merged, table


def _large(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it. ``n`` edges at most."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(few_or_merged(least, 2 * n), "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    """A node and its smaller neighbours all move to the smallest of them. Needs u > v, ``n`` at most."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(few_or_merged(least, n), "u").where("v > m")
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """Rows and a sum over them: two numbers that tell whether a round changed anything."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long ``u``, ``v``): the smallest node reachable.

    Each round halves the way to the root at least, writes its edges to the shared folder and
    groups by minimum only, so a node with very many links is never gathered. Loops, repeated and
    reversed edges are allowed; null ends are dropped; no edges give no rows.
    """
    edges = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = table(edges.distinct(), f"{label}-edges")
    before = _state(edges)
    while before[0]:
        edges = table(_large(edges, before[0]), f"{label}-large")
        edges = table(_small(edges, before[0]), f"{label}-small")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

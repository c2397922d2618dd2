"""Connected components of an edge table by alternating large-star and small-star steps, all of it DataFrame operations.

Each step is an aggregate with map-side combine, so a hub with a third of all edges reaches its reducer as one row per map
task, and an equi-join of the edges with the nodes' least neighbours. Those are written first: up to ``BROADCAST_ROWS`` of
them (16 bytes each) are broadcast; more are joined by a shuffle of two plain tables, whose hot partitions adaptive
execution can split. Every step is written to the shared folder, and what a round leaves behind is removed; the rounds end
when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import Scratch

BROADCAST_ROWS = 1_000_000


def _mark(edges: DataFrame) -> tuple:
    """What tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def _least(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, m): the least of each node's neighbours and itself."""
    least = scratch.cut(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return F.broadcast(least) if least.count() <= BROADCAST_ROWS else least


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = both.filter("v > u").join(_least(both, scratch), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return scratch.cut(found, "large-star")


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges run from the larger node u to the smaller node v."""
    least = _least(edges, scratch)
    others = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return scratch.cut(others.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of an edge (u, v) but the smallest of its component, and that smallest node."""
    scratch = Scratch(edges.sparkSession)
    edges = scratch.cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v"), "edges")
    now, before = _mark(edges), None
    while now[0] and now != before:
        before, old = now, scratch
        scratch = Scratch(edges.sparkSession)
        edges = _small_star(_large_star(edges, scratch), scratch)
        now = _mark(edges)
        old.remove()
        scratch.remove(but=1)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

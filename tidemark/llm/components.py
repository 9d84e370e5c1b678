"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize, written_in


def _toward_least(edges: DataFrame, at: str, other: str) -> DataFrame:
    """``edges`` with the least neighbour ``m`` of ``at``; a groupBy and a join, so a hub is split."""
    least = edges.groupBy(at).agg(F.min(other).alias("m"))
    return edges.join(least, at)


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Each round is written to the shared folder. Rounds grow with the logarithm of the
    longest path. Repeated and reversed links and loops do no harm; no links give no rows.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), "edges"
    )
    shape = _shape(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = _toward_least(both, "x", "y").filter("y > x").select(F.col("y").alias("x"), F.least("x", "m").alias("y")).distinct()
        small = _toward_least(large, "x", "y")
        parts = [small.select("x", F.col("m").alias("y")), small.filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))]
        older, edges = edges, materialize(reduce(DataFrame.unionByName, parts).distinct(), "edges")
        discard(older)
        if shape == (shape := _shape(edges)):
            break
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    found = edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(roots)
    return written_in(found, edges.written_folder)

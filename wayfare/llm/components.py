"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import saved


def _rows_and_hash(edges: DataFrame) -> tuple[int, int | None]:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def _round(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour; then every neighbour below it is."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("low")).select("b", F.least("b", "low").alias("low"))
    large = edges.join(low, "b").select("a", F.col("low").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("low"))
    small = large.join(low, "a")
    return small.selectExpr("a", "low AS b").union(small.filter("b <> low").selectExpr("b AS a", "low AS b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the links (a, b): the smallest id reachable.

    A node's links are only reduced to their minimum and joined with it, so a node with very many links
    is combined in the map tasks, and its join can be split. Every round is written and read again.
    """
    canonical = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(canonical.distinct(), "links")
    state = _rows_and_hash(edges)
    while state[0]:
        edges = saved(_round(edges), "links")
        state, before = _rows_and_hash(edges), state
        if state == before:
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)

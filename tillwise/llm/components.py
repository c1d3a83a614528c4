"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tillwise.operators.joins import split_join
from tillwise.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a written table, and what tells whether they changed, observed while they are written."""
    seen = Observation()
    state = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("hash"), F.sum(F.col("b").cast("decimal(38,0)")).alias("sum"))
    return durable(edges.observe(seen, *state)), seen.get


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``edges`` (a, b long).

    Large and small stars in turn until the edges stay the same; each round is written to the shared folder, which
    cuts the lineage. Hubs are summed up on the map side and their edges may be split by the adaptive join.
    """
    edges, before = _stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while before["n"]:
        edges, after = _stored(_small_star(_large_star(edges)))
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def joined_components(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root with more edges (a, b) between nodes: only the components that these touch are gone through again."""
    known = roots.toDF("node", "root")
    lifted = edges
    for side in ("a", "b"):
        other = known.toDF("_node", "_root")
        lifted = lifted.join(other, F.col(side) == F.col("_node"), "left").withColumn(side, F.coalesce("_root", side)).drop("_node", "_root")
    if edges.isEmpty():
        return known
    over = durable(components(lifted.select("a", "b")))
    moved = split_join(known, over.toDF("root", "_above"), "root", "left").select("node", F.coalesce("_above", "root").alias("root"))
    return moved.union(over.join(known, "node", "left_anti"))

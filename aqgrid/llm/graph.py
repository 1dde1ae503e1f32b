"""Connected components of a graph given as rows, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aqgrid.llm.common import discard, written


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written, with their number and the sum of their hashes, which Spark observes while it writes."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashes.alias("hash")), "edges")
    return out, seen.get


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of ``edges`` (a, b: long); the component is its smallest node.

    Both steps keep the components; they end when every node points to the smallest one. Each is a minimum with partial
    aggregation and a join that Spark may split at hot nodes; the rows are written to the shared folder in between.
    Loops and repeated or reversed edges do no harm.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b"))).distinct()
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, seen = _stored(e)
    while seen.get("n"):
        old, star, before = e, _large_star(e), seen
        e, seen = _stored(_small_star(star, least := _least(star)))
        discard(old, star, least)
        if seen == before:
            break
    return nodes.join(e.withColumnsRenamed({"u": "node", "v": "component"}), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, written, so that the join with it finds plain exchanges and Spark may split a hot node."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(e: DataFrame) -> DataFrame:
    """Larger neighbours of a node are tied to the smallest node around it."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    out = both.where("v > u").join(least.select("u", F.least("u", "m").alias("m")), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    out = written(out.distinct(), "star")
    discard(least)
    return out


def _small_star(e: DataFrame, least: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    tied = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()

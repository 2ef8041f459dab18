"""Connected components of an edge table by alternating stars.

Large star links every larger neighbour of a node to the smallest one around
it, small star every smaller one; both keep the components and, alternated,
turn each into a star around its smallest node (Kiveris et al., "Connected
components in MapReduce and beyond", 2014).  Every round is written reliably,
so a lost executor costs at most the round at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import IDS_PER_PARTITION, gathered, stash


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        around = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("a", "b")
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = around.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("centre"), F.least("a", "m").alias("m"))
    joined = around.join(smallest, around["a"] == smallest["centre"])
    if large:  # not more edges than before, so repeated ones may stay until the small star
        return joined.where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        joined.select(F.col("a"), F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether every larger node (a) of ``edges`` has one smaller one (b), which is no larger one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    amiss = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or up > 0 and down > 0")
    return amiss.agg(F.count(F.lit(1))).first()[0] == 0


def leaves(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, component (the smallest node of its component) for every node of ``edges`` (a, b) but the smallest ones.

    Null ends and loops link nothing; repeated edges count once; no edges give
    no rows.  Each round is one write, which counts its edges on the way; the
    rounds end when the edges are stars, which another round would not change.
    ``rows`` is the number of ``edges`` where it is known.
    """
    edges = edges.select("a", "b").where("a <> b")
    while True:
        round_ = _star(_star(edges, large=True), large=False)
        # The large star has no more edges than before, the small star twice as many at most.
        edges = stash(round_ if rows is None else gathered(round_, 2 * rows, IDS_PER_PARTITION), "component-edges", n=F.count(F.lit(1)))
        rows = edges.measured["n"]
        if not rows or _is_star(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """``leaves`` and a row for the smallest node of each component."""
    found = leaves(edges)
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())

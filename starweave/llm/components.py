"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.session import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every larger (or not larger) neighbour of a vertex to the smallest one it has."""
    around = _both(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    found = around.join(lowest, "a")
    if large:
        out = found.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = found.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b"))


def _is_open(edges: DataFrame) -> bool:
    """Whether a vertex has two smaller neighbours, or one on either side: not every component is a star yet."""
    ends = edges.selectExpr("a v", "1 up", "0 down").union(edges.selectExpr("b v", "0 up", "1 down"))
    around = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not around.where("up + down > 1 and up > 0").isEmpty()


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``v, root`` for every vertex of the edges ``a, b``: the smallest vertex it can reach.

    ``known`` may hold the result for other edges; then the result is for all edges together.
    Every round writes its edges to the shared folder, so lineage stays short and a lost executor
    costs no earlier round. A vertex with very many neighbours is pre-aggregated by each task, and
    its rows meet their minimum in an ordinary join that Spark can split. No edges give no rows.
    """
    if known is not None:
        edges = edges.select("a", "b").union(known.select(F.col("v").alias("a"), F.col("root").alias("b")))
    current = edges.select("a", "b").where(F.col("a") != F.col("b"))
    while True:
        current = stage(_star(_star(current, True), False).distinct(), "edges")
        if not _is_open(current):
            break
    roots = current.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("v"), "root").distinct())

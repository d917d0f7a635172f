"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store


def _star(links: DataFrame) -> DataFrame:
    """One row (node, low) with the smallest node of each closed neighbourhood."""
    return links.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("x")).select("x.*")


def _step(links: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest node around: the larger neighbours
    (large star) or the smaller ones and the node itself (small star)."""
    around = _both(links) if large else links.select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    # Stored, so that the join may split a node of very many links.
    low = store(_star(around))
    joined = around.join(low, "node")
    if large:
        out = joined.where("other > node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("other").alias("a"), F.col("low").alias("b")).union(
            low.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node points at one smaller node that points nowhere."""
    twice = links.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).where("n > 1 or a < b").select("a")
    chained = links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a")
    return twice.union(chained).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected links (a, b); the
    component is its smallest node.  Each round is written to the shared folder,
    so neither the lineage nor the driver grows; rounds grow with the logarithm
    of the longest chain.  An empty table gives an empty result."""
    now = store(links.select("a", "b").where("a <> b").distinct())
    while not _settled(now):
        now = store(_step(_step(now, True), False))
    low = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(low)

"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Large star: every node links its larger neighbours to its smallest
    neighbour (or itself).  Small star: every node links itself and its smaller
    neighbours to the smallest of them."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    j = both.join(least, "a")
    if large:
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` edges -> ``node, label`` with the smallest node of each
    component; nodes without an edge to another node are left out.

    Runs to the fixpoint (a logarithmic number of rounds on most graphs); each
    round is written to the shared checkpoint folder.
    """
    e = staged(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        e = staged(_star(_star(e, large=True), large=False))
        # done when every edge leads to a node that leads nowhere: stars only
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())

"""Connected components of a large sparse graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import staged


def _star(edges: DataFrame, large: bool, step: str) -> DataFrame:
    """Hang neighbours of each node on their smallest: the larger ones (large
    star) or the node and its smaller ones (small star)."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    if large:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        least = staged(least, step + "-least")  # a fresh join side: AQE can split a hot node
        out = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter("b < a")
        least = staged(down.groupBy("a").agg(F.min("b").alias("m")), step + "-least")
        near = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = near.union(least.select("a", F.col("m").alias("b")))
    return staged(out.filter("a <> b").distinct(), step)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; ``root`` is the
    smallest node of its component. Self-loops and repeats are harmless; no
    edges give no rows.

    Each round keeps components and never adds edges; it ends when a round
    changes nothing, i.e. every node hangs on its root. Only a count and a
    checksum reach the driver.
    """
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = _star(_star(edges, True, "cc-large"), False, "cc-small")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(edges.select(F.col("b"), F.col("b")).distinct())

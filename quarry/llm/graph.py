"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round.  ``edges`` has (u, v) with u > v.  Large star: every larger neighbour of a node is linked to the
    smallest member of the node's neighbourhood.  Small star: the same for the smaller neighbours and the
    node itself.  The minimum is joined back instead of gathering neighbourhoods, so a hub's rows stay spread."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = (both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "components", rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node that occurs in ``edges`` (columns ``a``, ``b``; long), where ``root`` is the
    smallest node of the component.  Each round is written to the shared folder; links never reach the driver,
    only one (count, checksum) row a round does.  An empty edge table gives an empty result."""
    now = scratch.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), f"{name}-0")
    last = None
    for i in range(1, rounds + 1):
        now = scratch.put(_star(_star(now, True), False), f"{name}-{i}")
        mark = tuple(now.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"{name}-{i - 1}")
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

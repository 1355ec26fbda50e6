"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``edges(a, b)`` of comparable ids -> ``(node, root)``, root the smallest id
    of the component, for every node of an edge.

    Each round hangs the larger neighbours of every node on its smallest
    neighbour (large star), then the smaller ones (small star), until every
    component is a star around its smallest id: O(log^2 n) rounds. The smallest
    neighbours are written before they are joined back, so both sides of the join
    are plain exchanges and AQE can split a node that holds most of the edges.
    Self-loops and NULLs are ignored; an empty table gives an empty result.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = scratch.write(e, f"{name}-0")
    step = 0
    while not _stars(e):
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")),
                            f"{name}-low-{step}")
        big = scratch.write(both.where("v > u").join(low, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                            f"{name}-big-{step}")
        least = scratch.write(big.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least-{step}")
        near = big.join(least, "u")
        e = scratch.write(
            near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-low-{step}", f"{name}-big-{step}",
                     f"{name}-least-{step}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(e: DataFrame) -> bool:
    """Every node hangs on one smaller node at most, and none that others hang on."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return (ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
            .where("up > 1 or up = 1 and root = 1").isEmpty())

"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from .common import written

MAX_ROUNDS = 60


# Rows of one node are spread over this many parts.
SALTS = 64
# Bytes of edges up to which the least neighbours (twice as much at most) are broadcast.
BROADCAST_BYTES = 4 * 1024 * 1024


def _with_least(rows: DataFrame, few: bool = False) -> DataFrame:
    """``rows`` (u, v) with ``m``, the least v of their u; a node's rows never meet in one task.

    The least is taken in one sum over the nodes and handed back to each part of a node; of
    ``few`` rows it is broadcast, and they stay where they are.
    """
    if few:
        return rows.join(F.broadcast(rows.groupBy("u").agg(F.min("v").alias("m"))), "u")
    salted = rows.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    least = salted.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("part").alias("parts"))
    return salted.join(least.select("u", "m", F.explode("parts").alias("part")), ["u", "part"]).drop("part")


def _large_star(edges: DataFrame, few: bool = False) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_least(both, few).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter(F.col("u") != F.col("v")))


def _small_star(edges: DataFrame, few: bool = False) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                   F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
    return (_with_least(down, few).select(F.explode(ends).alias("e")).select("e.u", "e.v")
            .filter(F.col("u") != F.col("v")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself: a round would change nothing."""
    nodes = edges.select("u", F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))
    counted = nodes.groupBy("u").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return counted.filter((F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("downs") == 1))).isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, root)`` for every node that is not its component's least node itself.

    ``edges`` has columns ``u`` and ``v`` of one orderable type.  Each round
    is written to the shared folder; the driver sees whether it was the last.
    """
    edges = written(edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    few = fits_broadcast(edges, BROADCAST_BYTES)       # a round never adds edges
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            break
        edges = written(_small_star(_large_star(edges, few), few), name)
    else:
        raise RuntimeError(f"no stable components after {MAX_ROUNDS} rounds")
    return edges.select("u", F.col("v").alias("root"))

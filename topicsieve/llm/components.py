"""Connected components by alternating large-star and small-star operations.

Edges are rows of whole-number ids, and every step is a join and an aggregation over
them, so nothing of the graph is gathered anywhere. Each step's edges and smallest
neighbours are stored: a hub's edges are then a plain skewed join side, which Spark
splits, and a lost executor costs no more than one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicsieve.llm.frames import scratch, stored


def _linked_to_smallest(arcs: DataFrame) -> DataFrame:
    """Each arc (u, v) with the smallest end of all arcs of u, u itself included."""
    smallest = stored(arcs.groupBy("u").agg(F.min("v").alias("m")), "smallest-neighbours")
    return arcs.join(smallest, "u").withColumn("m", F.least("m", "u"))


def large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to its smallest one."""
    arcs = stored(edges.union(edges.select("v", "u")).toDF("u", "v"), "arcs")
    return (
        _linked_to_smallest(arcs)
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest one; edges have u > v."""
    linked = _linked_to_smallest(edges)
    neighbours = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = linked.select("u", F.col("m").alias("v"))
    return neighbours.union(own).where("u != v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number and order-free checksum of the edges."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reached) of every node of an edge.

    ``edges`` has two columns of ids in any order; self-loops, repeated edges and edges
    with a null end are taken. Nodes without another one have no row. The result is
    stored; the steps' tables are freed.
    """
    u, v = (F.col(c).cast("long") for c in edges.columns[:2])
    tidy = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), (u + v).alias("both"))
    spark = edges.sparkSession
    with scratch(spark) as keep:
        now = stored(tidy.where("both IS NOT NULL AND u != v").select("u", "v").distinct(), "edges")
        state = _state(now)
        while state[0]:
            with scratch(spark) as keep_step:
                now = keep_step(small_star(stored(large_star(now), "large-star")), "small-star")
            before, state = state, _state(now)
            if before == state:
                break
        # stars now: every node but the smallest has one edge, to the smallest
        centres = now.select(F.col("v").alias("u"), "v").distinct()
        return keep(now.union(centres).toDF("node", "component"), "components")

"""Connected components of a distributed edge list by alternating stars.

Every round replaces edges by edges to smaller nodes until each component is a star
around its smallest node. A node's neighbours are only ever reduced to their minimum,
and joined on keys whose partitions Spark can split, so a node may have any number of
neighbours. Each round is written, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.tables import staged


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a").where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): every node a of a component but the smallest, and the smallest, b.

    ``edges`` has integer columns a and b in any order; loops and repeats do not matter.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    now = staged(now.distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = staged(_small(_large(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now

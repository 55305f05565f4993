"""Connected components by alternating stars, all on DataFrames.

Every round hangs each node's neighbours on its smallest neighbour, first the larger ones, then the smaller ones.
Stars form after about log(n) rounds. Both steps are an aggregate with map-side combine and a join on a node, whose
large side Spark can split, so a node with very many edges does not end in one task. Only two numbers of each
round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select("lo", "hi")).toDF("u", "v")
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(lowest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    lowest = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = pairs.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi != lo")
    return moved.union(lowest).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node that has an edge to another one.

    ``a`` and ``b`` are of one orderable type. Edges with a null end, edges of a node with itself and repeated
    edges change nothing. No edges give no rows.
    """
    left, right = F.col(a), F.col(b)
    pairs = edges.select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo"))
    pairs = checkpointed(pairs.filter(left.isNotNull() & right.isNotNull() & (F.col("hi") != F.col("lo"))).distinct())
    state = _state(pairs)
    while state[0]:
        pairs = checkpointed(_small_star(_large_star(pairs)))
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)

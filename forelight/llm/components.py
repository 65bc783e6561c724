"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forelight.llm.common import Scratch


#: Links that a task of a round may well hold.
EDGES_PER_TASK = 50_000


def components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component): each linked node and the least node it reaches.

    ``links`` has long columns a and b. Every round points nodes' larger
    neighbours, then nodes' smaller ones, to the least neighbour; rounds are
    few (a logarithm of the nodes), each is written to the shared folder, and
    nothing but two numbers reaches the driver. Links of a node with very many
    are spread by the least-neighbour aggregation and by skewed-join splits.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = scratch.keep(links.where("a <> b").select(a.alias("u"), b.alias("v")).distinct(), f"{name}-0")
    state, k = _state(edges), 0
    parts = max(4, -(-state[0] // EDGES_PER_TASK))
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("m", "u").alias("m"))
        large = both.join(least, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large, f"{name}-{k}l", parts)
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = large.join(least, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.keep(small.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), f"{name}-{k + 1}", parts)
        before, state = state, _state(edges)
        scratch.drop(f"{name}-{k}l", f"{name}-{k}")
        k += 1
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).head())

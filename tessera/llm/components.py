"""Connected components of a table of links, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) for every node of ``links(a, b)``.

    Rounds of two steps: every node hands its smallest neighbour to its larger neighbours, then to its smaller
    ones. Each round keeps what is connected and shortens every path, so the number of rounds grows with the
    logarithm of the longest path. Smallest neighbours are aggregates and partners are found by joins, so the
    neighbours of a node are never gathered. Smallest neighbours are written before they are joined: both sides of the
    join are plain shuffles then, and adaptive execution splits a node with very many neighbours. A lost executor
    costs one step at most.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    state = _fingerprint(edges)
    for _ in range(_ROUNDS):
        edges = written(_small_star(written(_large_star(edges), "links")), "links")
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {_ROUNDS} rounds")
    # Settled: every link goes from a node to its root.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    # The larger neighbours of u are the nodes that have u as their smaller end.
    return edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

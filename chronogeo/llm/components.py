"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour to the smallest one. Small star: the same for smaller neighbours and oneself.

    The smallest neighbour comes from an aggregate with partial minima and goes back by a join, so a node with very many
    neighbours needs no task of its own. The files of `edges` go.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    done = cut(out.filter("a > b").distinct())
    discard(least, edges)
    return done


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): component is the smallest node that links lead to.

    Null ends and loops are ignored. Rounds grow with the logarithm of the longest path; each is written to the shared
    folder. The loop ends only when a round changes nothing.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("ok"))
                .filter("ok").select("a", "b").distinct())
    state = _state(edges)
    while state[0]:
        edges = _star(_star(edges, True), False)
        before, state = state, _state(edges)
        if state == before:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))

"""Connected components of a graph given as a table of edges, as Spark joins.

Alternating large-star and small-star steps: every node hands its larger
neighbours, then itself and its smaller ones, to the smallest node it knows.
Nothing is collected but two numbers a round; each round's edges are written
to the shared checkpoint folder, so a lost executor costs a re-read, and
removed after the next.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import remove, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """edges have v < u."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).union(rest).filter("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component: its smallest node.

    ``edges``: two long columns, a and b; order, repeats and loops don't matter.
    """
    e = edges.toDF("a", "b").filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    spark, old, kept = e.sparkSession, [], []
    e = written(e, "edges", kept)
    state = _state(e)
    for _ in range(max_rounds):
        old, kept = kept, []
        e = written(_small_star(_large_star(e)), "edges", kept)
        remove(spark, old)
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

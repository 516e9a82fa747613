"""Connected components of a link table, as Spark joins and partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: root is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014), each of which hangs
    neighbours of a node on the smallest of them, until every component is a star.  A node with
    many neighbours costs one partial minimum and a join that adaptive execution can split;
    nothing is collected.  The edges of each round are a table in the shared folder.
    """
    edges = written(_tidy(links.select(F.col("a").cast("long"), F.col("b").cast("long"))), "links")
    seen = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
                             .distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Larger end first, without loops and repeats."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("u")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _tidy(moved)


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = edges.join(least, F.col("a") == F.col("u")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _tidy(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))

"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the least node of its component.

    Large and small star operations in turn: each node's links move to its
    least neighbour, so components shrink to stars in about logarithmically
    many rounds.  Only least neighbours are aggregated, so a node with very
    many links is combined before the shuffle.
    """
    def contents(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    small = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    now, before = contents(small), None
    while now != before:
        # large star: every larger neighbour of a node is linked to the node's least neighbour or itself
        both = small.unionByName(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a > b").distinct())
        # small star: a node and its smaller neighbours are linked to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = materialise(
            large.join(low.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a > b").unionByName(low.select("a", F.col("m").alias("b"))).distinct(), tidy=False)
        now, before = contents(small), now
    return small.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

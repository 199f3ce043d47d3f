"""Connected components of a link table by alternating large and small stars, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged, join_hot


def _large(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest node that u sees."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"))
    return join_hot(both.where("v > u"), least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, are tied to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    others = join_hot(e, least, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v) that is not itself the smallest of its component.

    Links may repeat, point either way or join a node to itself. Each round writes its links to the shared
    folder; rounds grow with the logarithm of a component's size, and end when every tree is a star.
    """
    tidy = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = Staged(tidy.distinct(), "links")
    while True:
        e = now.df
        stats = e.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n").alias("most")).first()
        if stats["most"] is None:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if stats["most"] == 1 and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mid = Staged(_large(e).distinct(), "links")
        new = Staged(_small(mid.df).distinct(), "links")
        now.drop()
        mid.drop()
        now = new

"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): root is the
    smallest node that can be reached.

    Alternates two steps until nothing changes.  Large step: every larger
    neighbour of a node is linked to the node's smallest neighbour.  Small
    step: the same for the neighbours that are not larger.  Each step is a
    minimum by key, reduced before the shuffle and written, and a join back:
    Spark knows the minima's size, so while they are small they go to where a
    hub's links lie, and beyond that its rows in the join can be split.  Every round is written to
    the shared folder; a lost executor repeats its tasks only, and nothing
    but two sums per round comes to the driver.  Self links and repeats are
    harmless; an empty table gives an empty result.
    """
    def star(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return edges.join(stored(least, f"{name}-least"), "u")

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def tidy(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = stored(tidy(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    before = mark(edges)
    while before[0]:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = tidy(star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = star(large)
        small = tidy(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionAll(small.select("u", F.col("m").alias("v"))))
        edges = stored(small, name)
        after = mark(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))

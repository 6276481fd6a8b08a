"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemeter.llm.expressions import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Every round first ties the larger neighbours of a node to its least neighbour, then the smaller
    ones, until nothing changes. Minima are combined before the shuffle and joins may split
    a hub; each round is stored in the shared folder, and only a count and a checksum reach the
    driver. Loops and repeated links do not matter.
    """

    def directed(df: DataFrame) -> DataFrame:
        return df.filter("u != v").distinct()

    def summary(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        return row["n"], row["sum"]

    edges = stored(
        directed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "links"
    )
    before = summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = directed(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(directed(small.unionByName(low.withColumnRenamed("m", "v"))), "links")
        after = summary(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)

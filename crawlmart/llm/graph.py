"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns a, b); the root is the
    smallest node of the component.

    Each round hangs every node's larger neighbours on its smallest neighbour, then every
    node's smaller neighbours on the smallest of them. Rounds are logarithmic in the size of a
    component. A node with a large share of the links is met by minima that are combined
    before the shuffle and by joins that adaptive execution splits. Only two sums per round
    reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = runtime.materialize(edges.filter("u > v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if (now := tuple(state)) == before or not state["n"]:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), "m")
        small = small.unionByName(least).select("u", F.col("m").alias("v"))
        edges = runtime.materialize(small.distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

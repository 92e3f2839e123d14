"""Crawl frontier over the follow graph (P5)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmart import runtime
from crawlmart.operators import blocks

# Levels of a large graph that take a round each; few graphs of people are deeper.
LEVELS = 8


class Bucketed:
    """A table whose rows lie in buckets of a key, so that a join on it moves the other side
    only. Its files are in the shared folder; the session's catalog knows its buckets until it
    is dropped."""

    def __init__(self, spark: SparkSession, tag: str, keys: list[str], n: int, part: str = ""):
        self.spark, self.keys, self.n, self.part = spark, keys, n, part
        self.path = runtime.new_dir(spark, tag)
        self.name = f"crawlmart_{tag}_{uuid.uuid4().hex}"

    def append(self, df: DataFrame) -> int:
        """Add rows, one file a bucket, and return their number."""
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("n")).repartition(self.n, *self.keys)
        out = rows.write.mode("append").bucketBy(self.n, *self.keys).sortBy(*self.keys)
        if self.part:
            out = out.partitionBy(self.part)
        out.option("path", self.path).saveAsTable(self.name)
        return seen.get["n"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def onward(graph: DataFrame, level: DataFrame, hot: DataFrame, n: int) -> DataFrame:
    """Whom a level leads to. The level is dealt over the graph's buckets, once for each part
    of a busy source; the graph stays where it is."""
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    at = level.select(F.col("user").alias("src")).join(hot, "src", "left").select("src", parts.alias("salt"))
    met = graph.join(at.repartition(n, "src", "salt"), ["src", "salt"], "left_semi")
    return met.select(F.col("dst").alias("user")).distinct()


def unseen(found: DataFrame, visited: DataFrame) -> DataFrame:
    """Those who were not visited yet; the visited stay in their buckets."""
    return found.join(visited.select("user"), "user", "left_anti")


def expand_frontier(
    edges: DataFrame, seeds: DataFrame, max_depth: int | None = None
) -> DataFrame:
    """(user, depth) of every user reached from the seeds over ``src -> dst`` edges.

    Edges are deduplicated and written once. A graph of many edges takes one round per level
    first: its edges lie in buckets of their source, sources with very many edges split over
    several, and visited users in buckets too, a folder per level. So a level moves itself and
    whom it leads to, and neither edges nor visited users. What lies deeper than ``LEVELS``
    levels, and all of a graph that one task can hold, is walked in blocks, where a round takes
    many levels. Lineage stays short; a lost executor repeats one round only.
    """
    spark = edges.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = seeds.select(F.col("user")).filter(F.col("user").isNotNull()).distinct()
    level = level.withColumn("depth", F.lit(0))
    kind = level.schema["user"].dataType
    links = edges.select(*[F.col(c).cast(kind).alias(c) for c in ("src", "dst")])
    links = links.filter(F.col("src") != F.col("dst")).distinct()
    path = runtime.new_dir(spark, "edges")
    n_edges = runtime.write_counted(links, path)
    edges = spark.read.schema(links.schema).parquet(path)
    if n_edges <= blocks.EDGES_PER_BLOCK:
        whole = edges.withColumn("salt", F.lit(0))
        return blocks.walk(whole, n_edges, runtime.materialize(level, "seeds"), 0, max_depth)
    schema = T.StructType([level.schema["user"], T.StructField("depth", T.IntegerType())])
    hot = runtime.materialize(runtime.hot_keys(edges, "src"), "hot")
    salt = F.pmod(F.xxhash64("dst"), F.coalesce("_salts", F.lit(1))).cast("int")
    graph = Bucketed(spark, "graph", ["src", "salt"], n)
    visited = Bucketed(spark, "visited", ["user"], n, part="depth")
    try:
        graph.append(edges.join(hot, "src", "left").select("src", "dst", salt.alias("salt")))
        depth, found = 0, visited.append(level)
        while found and depth < LEVELS and (max_depth is None or depth < max_depth):
            level = visited.read().filter(F.col("depth") == depth)
            depth += 1
            new = unseen(onward(graph.read(), level, hot, n), visited.read())
            found = visited.append(new.withColumn("depth", F.lit(depth)))
        reached = spark.read.schema(schema).parquet(visited.path)
        if not found or depth == max_depth:
            return reached
        return blocks.walk(graph.read(), n_edges, reached, depth, max_depth)
    finally:
        graph.drop()
        visited.drop()

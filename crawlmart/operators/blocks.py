"""Blocks of a graph, each held by one task, for walks of very many levels (P5)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmart import runtime

# Edges of a block; one may get up to about three times as many, as clusters are kept whole.
EDGES_PER_BLOCK = 2_000_000
# Links between clusters that the driver brings into an order, at most.
DRIVER_LINKS = 300_000


def clusters(graph: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(node, cluster) of the hashed users, and (a, b, n) with the number of edges from one
    cluster to another. A node joins the neighbour, or itself, whose hash is the smallest;
    clusters are joined in the same way until their links fit the driver. Nothing if they stop
    getting fewer before that. Equal hashes put users into one cluster and do no harm."""
    spark = graph.sparkSession
    links = graph.select(F.xxhash64("src").alias("a"), F.xxhash64("dst").alias("b"), F.lit(1).alias("n"))
    chain, before, turn = None, None, 0
    while True:
        known, salt = links.select("a", "b"), F.lit(turn)
        near = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = F.least(F.min(F.xxhash64("b", salt)), F.xxhash64("a", salt))
        label = runtime.materialize(near.groupBy("a").agg(least.alias("c")), "labels")
        start = label.select("a", F.col("c").alias("x"))
        end = label.select(F.col("a").alias("b"), F.col("c").alias("y"))
        made = (
            links.join(start, "a").join(end, "b")
            .groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("n").alias("n"))
        )
        path = runtime.new_dir(spark, "links")
        count = runtime.write_counted(made, path)
        links = spark.read.schema(made.schema).parquet(path)
        if chain is None:
            chain = label.select(F.col("a").alias("node"), F.col("c").alias("cluster"))
        else:
            step = label.select(F.col("a").alias("cluster"), "c")
            chain = chain.join(step, "cluster").select("node", F.col("c").alias("cluster"))
        if count <= DRIVER_LINKS:
            return chain, links
        if before is not None and count > 0.9 * before:
            return None
        before, turn = count, turn + 1


def in_order(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links, and their numbers in an order in which neighbours are near each
    other: breadth first, from a node at the rim of each connected part."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    here, there = ends, np.concatenate([ends[len(a) :], ends[: len(a)]])
    by_node = np.argsort(here, kind="stable")
    there, start = there[by_node], np.searchsorted(here[by_node], np.arange(len(nodes) + 1))

    def sweep(first: int, seen: np.ndarray) -> list[int]:
        out, seen[first] = [first], True
        for at in out:
            near = there[start[at] : start[at + 1]]
            near = np.unique(near[~seen[near]])
            seen[near] = True
            out.extend(near.tolist())
        return out

    tried, seen, order = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool), []
    for node in range(len(nodes)):
        if not tried[node]:
            order += sweep(sweep(node, tried)[-1], seen)
    return nodes, np.array(order, dtype=np.int64)


def cut(graph: DataFrame, n_edges: int) -> DataFrame:
    """(src, dst, block) of a graph with the ``salt`` of busy sources, written in a folder per
    block. Neighbouring clusters share a block; where there are none in an order that the
    driver can hold, and inside a cluster larger than a block, the hash of the source decides.
    It only settles how often a walk changes between blocks, not what it finds."""
    spark, place = graph.sparkSession, F.xxhash64("src", "salt")
    n_blocks = -(-n_edges // EDGES_PER_BLOCK)
    grouped = clusters(graph) if n_blocks > 1 else None
    if grouped is None:
        made = graph.withColumn("block", F.pmod(place, F.lit(max(n_blocks, 1))).cast("int"))
    else:
        chain, links = grouped
        rows = links.toArrow()
        a, b, n = (rows[c].to_numpy() for c in ("a", "b", "n"))
        nodes, order = in_order(a, b)
        load = np.bincount(np.searchsorted(nodes, a), weights=n, minlength=len(nodes))[order]
        first = (np.cumsum(load) - load) // EDGES_PER_BLOCK
        parts = np.maximum(1, np.ceil(load / EDGES_PER_BLOCK))
        table = [tuple(map(int, r)) for r in zip(nodes[order], first, parts)]
        blocks = spark.createDataFrame(table, "cluster long, first int, parts int")
        homes = chain.join(blocks, "cluster").select("node", "first", "parts")
        block = F.col("first") + F.pmod(place, F.col("parts")).cast("int")
        made = graph.withColumn("node", F.xxhash64("src")).join(homes, "node").withColumn("block", block)
    made = made.select("src", "dst", "block")
    path = runtime.new_dir(spark, "blocks")
    made.repartition("block").write.partitionBy("block").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _walker(max_depth: int | None):
    """A function that walks one block: from the users whose depth is news, as far as edges of
    the block lead to smaller depths than are known."""

    def run(edges, marks):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # One dictionary for all chunks: Arrow numbers a chunked array as a whole.
        named = pa.chunked_array([*edges["src"].chunks, *edges["dst"].chunks]).dictionary_encode()
        ends = np.concatenate([c.indices.to_numpy() for c in named.chunks])
        users = named.chunk(0).dictionary
        x, y = ends[: edges.num_rows], ends[edges.num_rows :]
        by_source = np.argsort(x, kind="stable")
        to, start = y[by_source], np.searchsorted(x[by_source], np.arange(len(users) + 1))
        at = pc.index_in(marks["user"], value_set=users).to_numpy()
        known = np.full(len(users), np.iinfo(np.int32).max, np.int32)
        known[at] = marks["depth"].to_numpy()
        depth = known.copy()
        news = at[marks["news"].to_numpy()]
        news = news[np.argsort(known[news], kind="stable")]
        starts, next_ = known[news].tolist(), 0
        level, d = [], 0
        while level or next_ < len(starts):
            d = d if level else starts[next_]
            if max_depth is not None and d >= max_depth:
                break
            while next_ < len(starts) and starts[next_] == d:
                # A user with news of its own that was met on a shorter way has gone on already.
                if depth[news[next_]] == d:
                    level.append(news[next_])
                next_ += 1
            onward = []
            for user in level:
                near = to[start[user] : start[user + 1]]
                near = near[depth[near] > d + 1]
                depth[near] = d + 1
                onward.extend(near.tolist())
            level, d = onward, d + 1
        found = np.flatnonzero(depth < known)
        by = np.full(len(found), edges["block"][0].as_py(), np.int32)
        columns = [users.take(pa.array(found)), pa.array(depth[found]), pa.array(by)]
        return pa.table(columns, names=["user", "depth", "by"])

    return run


def walk(
    graph: DataFrame, n_edges: int, reached: DataFrame, last: int, max_depth: int | None = None
) -> DataFrame:
    """(user, depth) of all that can be reached, after the levels up to ``last`` in ``reached``.

    A round walks the blocks that hold edges of users with news, each to its end, and tells
    users of other blocks; it ends when nobody's depth gets smaller. So there are as many
    rounds as a shortest way changes between blocks, however many levels it has. A round reads
    the edges of those blocks alone, and writes only the depths that it made smaller.
    """
    spark = graph.sparkSession
    edges = cut(graph, n_edges)
    homes = runtime.materialize(edges.select(F.col("src").alias("user"), "block").distinct(), "homes")
    path, turn = runtime.new_dir(spark, "heard"), 0
    found = T.StructType([*reached.schema.fields, T.StructField("by", T.IntegerType())])
    schema = T.StructType([*found.fields, T.StructField("turn", T.IntegerType())])
    # Users of earlier levels have gone on already, in all blocks.
    began = {"by": F.lit(-1), "turn": F.when(F.col("depth") == last, 0).otherwise(-1)}
    reached.withColumns(began).write.partitionBy("turn").parquet(path)
    while True:
        heard = spark.read.schema(schema).parquet(path)
        best = heard.groupBy("user").agg(
            F.min("depth").alias("depth"), F.max("turn").alias("turn"), F.min_by("by", "depth").alias("by")
        )
        # The block that found a depth has gone on from there.
        news = (F.col("turn") == turn) & (F.col("block") != F.col("by"))
        told = heard.filter(F.col("turn") == turn).join(homes, "user").filter(news).select("block")
        active = F.col("block").isin([r["block"] for r in told.distinct().collect()])
        marks = best.join(homes.filter(active), "user").select("block", "user", "depth", news.alias("news"))
        met = (
            edges.filter(active).groupBy("block").cogroup(marks.groupBy("block"))
            .applyInArrow(_walker(max_depth), found)
            .groupBy("user").agg(F.min("depth").alias("depth"), F.min_by("by", "depth").alias("by"))
        )
        old = best.select("user", F.col("depth").alias("old"))
        lower = met.join(old, "user", "left").filter(F.col("old").isNull() | (F.col("depth") < F.col("old")))
        turn += 1
        if runtime.write_counted(lower.drop("old"), f"{path}/turn={turn}") == 0:
            return best.select("user", "depth")

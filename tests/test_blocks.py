"""Walks of a graph in blocks against a small brute-force version, and how many rounds they take."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.operators import blocks, frontier


def levels(edges, seeds, max_depth=None):
    leads = {}
    for s, d in edges:
        leads.setdefault(s, set()).add(d)
    depth, level, at = {s: 0 for s in seeds}, set(seeds), 0
    while level and at != max_depth:
        at += 1
        level = {d for s in level for d in leads.get(s, ())} - set(depth)
        depth |= {d: at for d in level}
    return depth


def band(n, width, rng):
    """Users in no order of their names, each followed by some of the next ones in a row."""
    names = [f"{rng.getrandbits(60):x}" for _ in range(n)]
    steps = [sorted({1, *rng.sample(range(1, width), 3)}) for _ in range(n)]
    return names, [(names[i], names[i + k]) for i in range(n) for k in steps[i] if i + k < n]


def graphs():
    rng = random.Random(3)
    names, far = band(400, 9, rng)
    hub = [("hub", f"h{i}") for i in range(150)] + [(f"h{i}", "hub") for i in range(0, 150, 7)]
    sparse = [(f"n{rng.randrange(200)}", f"n{rng.randrange(200)}") for _ in range(260)]
    ring = [(f"r{i}", f"r{(i + 1) % 120}") for i in range(120)] + [("r5", "r90"), ("r90", "r20")]
    apart = [("x", "y"), ("y", "x"), ("z", "z"), (None, "x"), ("x", None)]
    whole = far + hub + sparse + ring + apart + [(names[200], "hub"), ("h149", "r0"), ("r60", "n1")]
    return {
        "whole": (whole, [names[0], "n7", "n7", None]),
        "nowhere": (apart, ["nobody", "z"]),
        "no seeds": (ring + sparse, []),
        "no edges": ([], ["a"]),
    }


@pytest.fixture
def small(monkeypatch):
    """Blocks of a few edges; sources of more than 40 are busy; one level before the blocks."""
    monkeypatch.setattr(blocks, "EDGES_PER_BLOCK", 300)
    monkeypatch.setattr(frontier, "LEVELS", 1)
    monkeypatch.setattr(runtime.hot_keys, "__defaults__", (40,))


@pytest.mark.parametrize(
    ("shape", "links"),
    [("whole", 100_000), ("whole", 30), ("whole", 0), ("nowhere", 30), ("no seeds", 30), ("no edges", 30)],
)
def test_depths_in_blocks(spark, small, monkeypatch, shape, links):
    monkeypatch.setattr(blocks, "DRIVER_LINKS", links)
    edges, seeds = graphs()[shape]
    df = spark.createDataFrame(edges * 2, "src string, dst string")
    got = frontier.expand_frontier(df, spark.createDataFrame([(s,) for s in seeds], "user string"))
    assert got.dtypes == [("user", "string"), ("depth", "int")]
    want = levels([e for e in edges if None not in e], [s for s in seeds if s])
    rows = got.collect()
    assert {r.user: r.depth for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize(("size", "max_depth"), [(300, 1), (300, 17), (100_000, 0), (100_000, 5)])
def test_a_largest_depth(spark, small, monkeypatch, size, max_depth):
    monkeypatch.setattr(blocks, "EDGES_PER_BLOCK", size)
    edges, seeds = graphs()["whole"]
    edges = [e for e in edges if None not in e]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = frontier.expand_frontier(df, spark.createDataFrame([(s,) for s in seeds], "user string"), max_depth)
    want = levels(edges, [s for s in seeds if s], max_depth)
    assert {r.user: r.depth for r in got.collect()} == want


@pytest.mark.parametrize("kinds", [("long", "long"), ("int", "long")])
def test_users_that_are_numbers(spark, small, kinds):
    edges = [(i, i + 1 + i % 3) for i in range(500)]
    df = spark.createDataFrame(edges, f"src {kinds[0]}, dst {kinds[0]}")
    got = frontier.expand_frontier(df, spark.createDataFrame([(0,)], f"user {kinds[1]}"))
    assert got.dtypes[0] == ("user", "bigint")
    assert {r.user: r.depth for r in got.collect()} == levels(edges, [0])


def test_a_shorter_way_found_later(spark, monkeypatch):
    """A block learns of a shorter way after it has walked on from a longer one."""
    side = F.pmod(F.col("src"), F.lit(2)).cast("int")
    monkeypatch.setattr(blocks, "cut", lambda graph, n_edges: graph.withColumn("block", side))
    even = [(i, i + 2) for i in range(0, 200, 2)]
    edges = even + [(0, 1), (1, 3), (3, 150), (150, 5), (5, 7)]
    df = spark.createDataFrame(edges, "src long, dst long")
    reached = spark.createDataFrame([(0, 0)], "user long, depth int")
    got = {r.user: r.depth for r in blocks.walk(df, len(edges), reached, 0).collect()}
    assert got == levels(edges, [0]) and got[150] == 3 and got[200] == 28


def test_many_levels_take_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(blocks, "EDGES_PER_BLOCK", 1500)
    monkeypatch.setattr(frontier, "LEVELS", 2)
    rounds, made = [], []
    counted, append = runtime.write_counted, frontier.Bucketed.append
    monkeypatch.setattr(runtime, "write_counted", lambda df, path: rounds.append(path) or counted(df, path))
    monkeypatch.setattr(frontier.Bucketed, "append", lambda self, df: made.append(self.path) or append(self, df))
    names, edges = band(1500, 12, random.Random(5))
    df = spark.createDataFrame(edges, "src string, dst string")
    got = frontier.expand_frontier(df, spark.createDataFrame([(names[0],)], "user string"))
    want = levels(edges, names[:1])
    assert {r.user: r.depth for r in got.collect()} == want and max(want.values()) > 120
    # The graph, the seeds and two levels; then the edges, their links and the rounds.
    assert len(made) == 4 and len(rounds) < 30


def test_blocks_hold_every_edge_once(spark, monkeypatch):
    monkeypatch.setattr(blocks, "EDGES_PER_BLOCK", 60)
    edges, _ = graphs()["whole"]
    df = spark.createDataFrame(edges, "src string, dst string").dropna().filter("src <> dst").distinct()
    hot = runtime.hot_keys(df, "src", 40)
    salt = F.pmod(F.xxhash64("dst"), F.coalesce("_salts", F.lit(1))).cast("int")
    graph = runtime.materialize(df.join(hot, "src", "left").select("src", "dst", salt.alias("salt")), "graph")
    cut = blocks.cut(graph, graph.count())
    assert sorted(map(tuple, cut.select("src", "dst").collect())) == sorted(map(tuple, df.collect()))
    sizes = [r["count"] for r in cut.groupBy("block").count().collect()]
    assert len(sizes) >= graph.count() // 180 and max(sizes) <= 3 * 60


def test_neighbours_lie_near_each_other():
    rng = np.random.default_rng(1)
    name = rng.permutation(5000)
    at = np.arange(4999)
    nodes, order = blocks.in_order(name[at], name[at + 1])
    place = np.argsort(name)[nodes[order]]  # the nodes of a line, from an end of it
    assert sorted(order.tolist()) == list(range(5000)) and set(np.abs(np.diff(place))) == {1}
    nodes, order = blocks.in_order(np.array([4, 9, 9]), np.array([4, 11, 9]))
    assert sorted(nodes[order].tolist()) == [4, 9, 11]

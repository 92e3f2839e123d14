"""Stores by key hash, reserved ids, complete batches, key history, commits, frontier plans."""

import re
import shutil
import time

import pytest
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.functions import html
from crawlmart.operators import extract, frontier, keyed
from crawlmart.plans import crawls
from crawlmart.sources import ids, keyed_store, sample, tables
from crawlmart.streaming import commits, history

SF = "/root/testdata/sf0.001"


def named(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("k"), "id").alias("k"), "id")


def scanned(spark, make, metric):
    """The rows of ``make()``, and a metric added up over the files that it scanned."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        metrics = [leaves.apply(k).metrics() for k in range(leaves.size())]
        return rows, sum(m.apply(metric).value() for m in metrics if m.contains(metric))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


# -- stores by key hash ----------------------------------------------------------------
def test_a_batch_reads_the_folders_of_its_keys(spark):
    rows = named(spark, 0, 20_000)
    store = keyed_store.KeyedStore(spark, runtime.new_dir(spark, "ks"), "k", rows.schema)
    store.write(rows, 0)
    store.write(named(spark, 20_000, 20_100), 1)
    batch = runtime.materialize(named(spark, 19_995, 20_005), "batch")
    rows, files = scanned(spark, lambda: store.near(batch.select("k")), "numFiles")
    _, every = scanned(spark, store.read, "numFiles")
    # At most ten folders of either batch, and the one file or so of the keys themselves.
    assert every > 300 and files <= 2 * 10 + 8
    assert sorted(r.id for r in rows) == list(range(19_995, 20_005))


def test_inserts_into_a_store_equal_those_into_a_table(spark):
    stored, path = named(spark, 0, 100), runtime.new_dir(spark, "ks")
    store = keyed_store.KeyedStore(spark, path, "k", stored.schema, 1)
    incoming = spark.createDataFrame([("k5", 1), ("k500", 2), ("k500", 3), (None, 4)], "k string, id long")
    assert [r.id for r in store.insert_if_absent(incoming.filter("id < 2"), ["id"]).collect()] == [1]  # none stored
    store.write(stored, 0)
    wanted = keyed.insert_if_absent(stored, incoming, "k", ["id"]).collect()
    assert store.insert_if_absent(incoming, ["id"]).collect() == wanted
    assert [r.id for r in wanted] == [2]
    # A batch without its mark is not seen; one that is written again replaces its own rows.
    named(spark, 500, 501).withColumn("prefix", F.lit("0")).write.partitionBy("prefix").parquet(f"{path}/batch=9")
    assert store.read().count() == 100
    store.write(named(spark, 0, 50), 0)
    assert store.read().count() == 50


def test_a_store_without_broadcast(spark, no_broadcast):
    stored = named(spark, 0, 100)
    store = keyed_store.KeyedStore(spark, runtime.new_dir(spark, "ks"), "k", stored.schema, 1)
    store.write(stored, 0)
    assert store.near(named(spark, 90, 110).select("k")).count() == 10


# -- ids -------------------------------------------------------------------------------
def test_two_loads_get_disjoint_ids(spark):
    ledger = ids.IdLedger(spark, runtime.new_dir(spark, "ids"))
    assert ledger.reserve("users", "", 10) == 0
    none = spark.createDataFrame([], "id long")
    first = keyed.assign_ids(named(spark, 0, 7).select("k"), none, "k", reserve=ledger.of("users", "a"))
    second = keyed.assign_ids(named(spark, 7, 12).select("k"), none, "k", reserve=ledger.of("users", "b"))
    assert sorted(r.id for r in first.collect()) == list(range(11, 18))
    assert sorted(r.id for r in second.collect()) == list(range(18, 23))
    assert ledger.reserve("users", "a", 7) == 10  # asked again after a failure
    assert ledger.reserve("columns", "a", 7) == 0
    assert ledger.reserve("users", "c", 0) == 22


def test_a_load_that_was_overtaken_looks_again(spark, monkeypatch):
    ledger = ids.IdLedger(spark, runtime.new_dir(spark, "ids"))
    ledger.reserve("t", "a", 5)
    stale, real = [[]], ids.IdLedger.entries
    monkeypatch.setattr(ids.IdLedger, "entries", lambda self, t: stale.pop() if stale else real(self, t))
    assert ledger.reserve("t", "b", 3) == 5  # its first look found nothing, as before load a
    assert [e["before"] for e in ledger.entries("t")] == [0, 5]


# -- complete batches ------------------------------------------------------------------
def test_readers_see_complete_batches_only(spark):
    root = runtime.new_dir(spark, "star")
    good, bad = named(spark, 0, 5), named(spark, 5, 9)
    tables.write_star({"dim": good}, {"fact": good}, root, 0)
    fails = bad.withColumn("id", F.when(F.col("id") >= 0, F.raise_error(F.lit("no disk"))).cast("long"))
    with pytest.raises(Exception, match="no disk"):
        tables.write_star({"dim": bad}, {"fact": fails}, root, 1)
    for name in ("dim", "fact"):
        assert tables.read_star(spark, root, name, good.schema).count() == 5
    tables.write_star({"dim": bad}, {"fact": bad}, root, 1)
    assert tables.read_star(spark, root, "fact", good.schema).count() == 9
    with pytest.raises(Exception, match="no disk"):  # a batch that is written again is open
        tables.write_star({"dim": bad}, {"fact": fails}, root, 1)
    assert tables.read_star(spark, root, "dim", good.schema).count() == 5
    assert tables.read_star(spark, runtime.new_dir(spark, "none"), "dim", good.schema).count() == 0


# -- key history -----------------------------------------------------------------------
def test_runs_cover_each_batch_once(spark):
    keys = history.KeyHistory(spark, "", "k", schemas.T.StringType(), fan=3)
    for batch in range(100):
        covered = sorted(
            b for level, k in keys.runs_before(batch) for b in range(k * 3**level, (k + 1) * 3**level)
        )
        assert covered == list(range(batch))
        assert len(keys.runs_before(batch)) <= 2 * 5


def test_bytes_read_stay_flat_over_fifty_batches(spark, monkeypatch):
    monkeypatch.setattr(history, "FOLDER_KEYS", 200)
    keys = history.KeyHistory(spark, runtime.new_dir(spark, "keys"), "k", schemas.T.StringType(), fan=4)
    keys.start(named(spark, 0, 3000).select("k"))
    assert keys.digits == 1
    read, seen = [], {f"k{i}" for i in range(3000)}
    for no in range(50):
        batch = named(spark, 2998 + 3 * no, 3004 + 3 * no)  # three or so of six are new
        keys.roll_up(no)
        found, size = scanned(spark, lambda no=no, batch=batch: keys.before(no, batch), "filesSize")
        earlier = {r.k for r in found}
        read.append(size)
        wanted = {f"k{i}" for i in range(2998 + 3 * no, 3004 + 3 * no)}
        assert wanted & seen <= earlier <= seen
        if no % 10 == 9:  # replayed: the same runs, written again
            keys.roll_up(no)
            assert {r.k for r in keys.before(no, batch).collect()} == earlier
        rows = sorted(wanted - earlier)
        seen |= set(rows)
        keys.add(spark.createDataFrame([(r,) for r in rows], "k string").coalesce(1), no)
    # Flat: runs of three levels and six folders at most, whatever the number of batches.
    assert max(read[40:]) < 2.0 * max(read[8:20])


# -- commits ---------------------------------------------------------------------------
def test_commits_hold_n_rows_also_after_a_restart(spark):
    schema = "seq long, key string"
    src, path, checkpoint, crashed = (runtime.new_dir(spark, n) for n in ("src", "commits", "cp", "crash"))
    made = commits.Commits(spark, path, spark.createDataFrame([], schema).schema, 10, ["seq"], "key")
    sizes, at = [7, 25, 1, 10, 4], 0
    for no, n in enumerate(sizes):
        rows = [(i, f"k{i}") for i in range(at, at + n)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        made.run(spark.readStream.schema(schema).parquet(src), checkpoint).awaitTermination()
        at += n
        assert made.read().count() == at // 10 * 10  # whole commits only
        if no == 2:  # as after a crash: the batch is written, but not known to be
            shutil.copytree(
                checkpoint.removeprefix("file:"), crashed.removeprefix("file:"),
                ignore=lambda d, names: [x for x in names if d.endswith("commits") and x.strip(".crc") == "2"],
            )
            made.run(spark.readStream.schema(schema).parquet(src), crashed).awaitTermination()
            assert made.read().count() == at // 10 * 10
    made.close()
    made.close()
    marks = {r["commit"]: r for r in made.marks().collect()}
    assert [marks[k]["n_rows"] for k in sorted(marks)] == [10, 10, 10, 10, 7]
    assert [x for k in sorted(marks) for x in marks[k]["items"]] == [f"k{i}" for i in range(47)]
    rows = made.read().collect()
    assert sorted((r["seq"], r["commit"]) for r in rows) == [(i, i // 10) for i in range(47)]


# -- frontier --------------------------------------------------------------------------
def exchanged(df):
    """The columns that each exchange of a plan moves."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)


def test_a_level_moves_neither_edges_nor_visited_users(spark, no_broadcast):
    n = 8
    graph = frontier.Bucketed(spark, "graph", ["src", "salt"], n)
    visited = frontier.Bucketed(spark, "visited", ["user"], n, part="depth")
    edges = spark.range(1000).selectExpr("id % 50 as src", "id as dst", "0 as salt")
    graph.append(edges)
    assert visited.append(spark.range(10).selectExpr("id as user", "0 as depth")) == 10
    assert visited.append(spark.range(10, 30).selectExpr("id as user", "1 as depth")) == 20
    hot = runtime.materialize(spark.createDataFrame([], "src long, _salts int"), "hot")
    level = visited.read().filter("depth = 1")
    found = frontier.unseen(frontier.onward(graph.read(), level, hot, n), visited.read())
    moved = exchanged(found)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and not any("dst" in m for m in moved)
    # The visited users appear once, in their buckets, below the last join and no exchange.
    below = plan[plan.index("LeftAnti") :]
    scan = [k for k, line in enumerate(below.splitlines()) if "graph" not in line and "visited" in line]
    assert scan and "Bucketed: true" in below.splitlines()[scan[-1]]
    tail = below.splitlines()[scan[-1] - 4 : scan[-1]]
    assert not any("Exchange" in line for line in tail)
    assert {r.user for r in found.collect()} == {d for d in range(1000) if 10 <= d % 50 < 30 and d >= 30}
    graph.drop(), visited.drop()


def test_a_busy_source_is_split(spark, monkeypatch):
    monkeypatch.setattr(runtime, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(runtime.hot_keys, "__defaults__", (50,))
    edges = spark.range(1, 601).selectExpr("if(id <= 400, 0, id) as src", "id as dst")
    edges = edges.union(spark.range(401, 601).selectExpr("id as src", "id + 1000 as dst"))
    edges = edges.union(spark.createDataFrame([(400, 401)], "src long, dst long"))
    found = frontier.expand_frontier(edges, spark.createDataFrame([(0,)], "user long"))
    depth = {r.user: r.depth for r in found.collect()}
    assert depth[0] == 0 and {depth[i] for i in range(1, 401)} == {1}
    assert depth[401] == 2 and depth[1401] == 3 and len(depth) == 403


# -- bodies in place -------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["follow", "column"])
def test_no_body_is_shuffled(spark, monkeypatch, no_broadcast, kind):
    plans, real = [], runtime.materialize

    def watched(df, tag):
        plans.append((tag, exchanged(df)))
        return real(df, tag)

    monkeypatch.setattr(runtime, "materialize", watched)
    if kind == "follow":
        out = crawls.crawl_follow_graph(
            real(sample.stored_users(spark, SF), "u"), real(sample.follow_responses(spark, SF), "r"))
    else:
        out = crawls.discover_columns(
            real(sample.users(spark, SF), "u"), real(sample.user_column_responses(spark, SF), "r"),
            sample.known_user_columns(spark, SF), spark.createDataFrame([], schemas.RANDOM_COLUMN))
    plans += [("result", exchanged(df)) for df in out]
    assert sum(len(moved) for _, moved in plans) > 5
    assert not [(tag, m) for tag, moved in plans for m in moved if "body#" in m]


# -- HTML ------------------------------------------------------------------------------
@pytest.mark.parametrize("part", ["<!--", "<script", "<img ", "<a href=", '<img src="', "<style>", "<a b='"])
def test_a_megabyte_of_unfinished_markup(spark, part):
    head = '<img src="/x.png"><a href="https://h/p/12?x">y</a>'
    text = head + part * (1_000_000 // len(part))
    start = time.time()
    got = spark.createDataFrame([(text,)], "t string").select(
        html.rewrite_images(F.col("t")).alias("i"), html.rewrite_article_links(F.col("t"), "B").alias("l"),
        html.cover_or_first_image(F.lit(""), F.col("t")).alias("c"),
    ).first()
    assert time.time() - start < 15
    assert got["c"].endswith("/x.png") and got["i"].startswith('<img src="https://pic')
    assert '<a href="B/article/12/">y</a>' in got["l"]
    assert got["i"].endswith(text[len(head) :]) and got["l"].endswith(text[len(head) :])


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("<table><tr><th>h</th></tr><tr><td> a </td><td>b<table><tr><td>c</td></tr></table>d</td><td>e</td></tr>"
         "<tr><td>f</td></tr></table>", [("a", "e"), ("c", None), ("f", None)]),
        ("<table><tr><td>skipped<tr><td>a<td><table><tr><td>x<td>y<td>z</table> own <td>c</table>",
         [("a", "c"), ("x", "z")]),
        ("</table><table><tr></tr><tr></tr><tr><TD></TD><td>2</td><th>t</th><td>3</td></TR></table>",
         [(None, None), (None, "3")]),
        ("<table><tr><td>1</td></tr></table><table><tr><td>a</td><td>b</td><td>c</td></tr></table>", [("a", "c")]),
        ("no table", []), (None, []), ("", []),
    ],
)
def test_nested_tables(spark, page, wanted):
    df = spark.createDataFrame([(1, page)], "id long, h string")
    rows = extract.html_table_rows_nested(df, "h", {"one": 1, "three": 3}, "id").orderBy("pos").collect()
    assert [(r["one"], r["three"]) for r in rows] == wanted
    assert [r["pos"] for r in rows] == list(range(len(wanted)))

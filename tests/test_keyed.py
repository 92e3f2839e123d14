"""Keyed writes: properties, skew and small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.operators import keyed, star
from crawlmart.operators.extract import SEQ


def items(spark, keys):
    return spark.createDataFrame(list(enumerate(keys)), "seq long, key string")


@pytest.mark.parametrize("seed", range(3))
def test_insert_if_absent_properties(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{rng.randrange(40)}" if rng.random() < 0.7 else "hot" for _ in range(300)]
    store = spark.createDataFrame([(f"k{i}",) for i in range(0, 40, 3)], "key string")
    incoming = items(spark, keys).orderBy(F.rand(seed))
    want, known = {}, {r.key for r in store.collect()}
    for no, key in enumerate(keys):
        if key not in known:
            want.setdefault(key, no)
    new = keyed.insert_if_absent(store, incoming, "key", ["seq"])
    assert {r.key: r.seq for r in new.collect()} == want
    again = keyed.insert_if_absent(store.unionByName(new.select("key")), incoming, "key", ["seq"])
    assert again.count() == 0
    flags = keyed.flag_new(store, incoming, "key", ["seq"]).collect()
    assert len(flags) == len(keys) and {r.seq for r in flags if r.is_new} == set(want.values())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_with_a_hot_key_and_nulls(spark, no_broadcast, how):
    keys = ["hot"] * 400 + [f"k{i % 150}" for i in range(450)] + [None] * 100
    facts = items(spark, keys)
    dim = spark.createDataFrame(
        [("hot", 0)] + [(f"k{i}", i) for i in range(0, 150, 2)], "key string, id int")
    assert not runtime.fits_broadcast(dim)
    got = runtime.lookup(facts, dim, "key", ["seq"], how)
    plain = facts.join(dim, "key", how)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_hot_keys_are_spread_over_tasks(spark, no_broadcast):
    facts = items(spark, ["hot"] * 4000 + [f"k{i}" for i in range(2000)])
    dim = spark.createDataFrame([("hot", 0)] + [(f"k{i}", i) for i in range(2000)], "key string, id int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = runtime.lookup(facts, dim, "key", ["seq"], rows_per_task=100).filter(F.col("key") == "hot")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 2000


def test_assign_ids(spark):
    existing = spark.createDataFrame([(41,)], "id long")
    new = spark.createDataFrame([(f"k{i}",) for i in range(1000)], "key string")
    ids = [r.id for r in keyed.assign_ids(new, existing, "key").collect()]
    assert sorted(ids) == list(range(42, 1042))
    none = spark.createDataFrame([], "id long")
    assert keyed.assign_ids(new.limit(1), none, "key").first().id == 1
    assert keyed.assign_ids(new.filter("false"), none, "key").count() == 0


def test_number_rows_follows_a_skewed_order(spark):
    order = [i if i % 3 else i * 10**9 for i in range(900)]
    df = spark.createDataFrame([(v,) for v in order], "seq long").repartition(7)
    got = {r.seq: r.rn for r in keyed.number_rows(df, ["seq"]).collect()}
    assert got == {v: i for i, v in enumerate(sorted(order), 1)}


def test_upsert_proxies(spark):
    existing = spark.createDataFrame(
        [(5, None, None, "old", 1, 2, False), (6, None, None, "idle", 1, 2, False)], schemas.PROXY)
    incoming = spark.createDataFrame(
        [(0, 0, "old", "9", "HTTP"), (0, 1, "new", "80", "hTTp"), (0, 2, "new", "81", "https"),
         (0, 3, "odd", "x", "HTTPS")], "resp_seq long, pos int, host string, port string, protocol string")
    rows = {r.host: r for r in keyed.upsert_proxies(existing, incoming, SEQ, "2020-01-01 00:00:00").collect()}
    assert (rows["old"].available, rows["old"].port, rows["old"].id) == (True, 1, 5)
    assert rows["idle"].available is False
    assert (rows["new"].port, rows["new"].protocol) == (80, 1) and rows["odd"].port is None
    assert sorted(r.id for r in rows.values()) == [5, 6, 7, 8]


def test_sets_and_flags(spark):
    users = spark.createDataFrame(
        [("a", True), ("b", False), ("c", None), ("d", False)], "slug string, crawl_follow boolean")
    assert sorted(r.slug for r in keyed.pending(users, "crawl_follow").collect()) == ["b", "d"]
    done = spark.createDataFrame([("b",), ("b",), ("c",)], "slug string")
    flags = {r.slug: r.crawl_follow for r in keyed.mark_done(users, done, "crawl_follow").collect()}
    assert flags == {"a": True, "b": True, "c": True, "d": False}
    assert sorted(r.slug for r in keyed.dequeue(users, done).collect()) == ["a", "d"]
    slugs = spark.createDataFrame([("a",), ("",), (None,), ("a",), ("z",)], "slug string")
    assert sorted(r.slug for r in keyed.discoverable(slugs, done).collect()) == ["a", "z"]
    popped, rest = keyed.pop_random(users.select("slug"), 3, 1)
    again, _ = keyed.pop_random(users.select("slug").repartition(3), 3, 1)
    assert popped.count() == 3 and rest.count() == 1
    assert {r.slug for r in popped.collect()} == {r.slug for r in again.collect()}
    checks = spark.createDataFrame(
        [("a", 404, 1.0), ("a", 404, 1.0), ("b", 200, 2.5), ("d", 200, 2.0)], "slug string, status int, elapsed double")
    assert sorted(r.slug for r in keyed.dead_links(users, checks, "slug").collect()) == ["b", "c", "d"]
    assert [r.slug for r in keyed.available(users, checks, ["slug"], ["slug"]).collect()] == ["d"]


def item(slug, name):
    return dict(zip(schemas.USER_ITEM.fieldNames(), ["1", name, "l", "h", slug, "", "", ""]))


def test_author_and_creator_new_in_the_same_batch(spark):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("resp_seq", T.LongType()), T.StructField("pos", T.IntegerType()),
        T.StructField("author", schemas.USER_ITEM), T.StructField("creator", schemas.USER_ITEM)])
    rows = [
        (1, 0, item("x", "as author"), item("x", "as creator")),
        (1, 1, item("y", "late"), item("z", "creator")),
        (0, 5, item("z", "author before"), item("y", "creator early")),
        (2, 0, item("known", "new name"), None),
    ]
    posts = spark.createDataFrame(rows, schema)
    users = spark.createDataFrame([("known", 7)], "slug string, id long")
    made = {r.slug: r for r in star.new_users(posts, users, "2020-01-01 00:00:00").collect()}
    assert {s: r.name for s, r in made.items()} == {
        "x": "as author", "y": "creator early", "z": "author before"}
    assert sorted(r.id for r in made.values()) == [8, 9, 10]
    all_users = users.unionByName(spark.createDataFrame([(s, r.id) for s, r in made.items()], "slug string, id long"))
    got = star.resolve_creator(star.resolve_author(posts, all_users), all_users).collect()
    assert {(r.resp_seq, r.pos): r.author_id for r in got}[(2, 0)] == 7
    assert {(r.resp_seq, r.pos): r.creator_id for r in got}[(2, 0)] is None
    assert all(r.author_id == r.creator_id for r in got if r.resp_seq == 1 and r.pos == 0)

"""Every input row of a load is new, known or a reject; stores can be written and read back."""

import json
from types import SimpleNamespace

import pytest

from crawlmart import runtime, schemas
from crawlmart.operators import keyed, paging
from crawlmart.plans import articles, crawls
from crawlmart.sources import tables

BASE, AT = "https://reader.example", "2024-05-06 07:08:09"


def post(slug, author="a", time="2024-01-02T03:04:05+08:00"):
    user = {"slug": author, "name": author, "hash": author} if author else None
    return {"slug": slug, "title": "t", "content": "c", "publishedTime": time, "author": user}


def posts_url(slug, page):
    return paging.POSTS_API.replace("{slug}", slug).replace("{offset}", str(20 * page))


def empty_store(spark):
    make = lambda schema: runtime.materialize(spark.createDataFrame([], schema), "store")
    return articles.Store(make(schemas.USER), make(schemas.COLUMN), make("md5 string, id long"))


@pytest.fixture
def responses(spark):
    good = [post("p1"), post("p2", author=None), post("p3", time="never"), post(None), post("p1")]
    rows = [
        (1, posts_url("c1", 0), json.dumps(good)),
        (2, posts_url("c1", 1), json.dumps([post("p9")])[:-4]),
        (3, posts_url("c1", 2), None),
        (4, posts_url("c2", 0), "[]"),
    ]
    info = [
        (1, "u1", json.dumps({"slug": "c1", "name": "C", "postsCount": 45})),
        (2, "u2", '{"slug": "c2", "na'),
        (3, "u3", "{}"),
    ]
    return spark.createDataFrame(rows, schemas.RESPONSE), spark.createDataFrame(info, schemas.RESPONSE)


def test_full_load_accounts_for_every_row(spark, responses):
    load = articles.ingest_articles(*responses, empty_store(spark), BASE, AT)
    rejects = sorted((r.resp_seq, r.pos is None, r.reject_reason) for r in load.rejects.collect())
    assert rejects == [
        (1, False, "bad_time"), (1, False, "no_author"), (1, False, "no_key"),
        (2, True, "broken_body"), (2, True, "broken_body"), (3, True, "broken_body"),
        (3, True, "no_key"),
    ]
    assert load.articles.count() == 1  # p1; its copy is known by then


def test_results_do_not_change_with_the_store(spark, responses, tmp_path):
    store = empty_store(spark)
    load = articles.ingest_articles(*responses, store, BASE, AT)
    path = str(tmp_path / "articles")
    tables.write_table(load.articles.select("md5", "id"), path, 0)
    again = articles.Store(
        load.users, load.columns, tables.read_store(spark, path, store.articles.schema)
    )
    second = articles.ingest_articles(*responses, again, BASE, AT)
    assert (second.articles.count(), second.users.count(), second.columns.count()) == (0, 0, 0)
    assert load.articles.count() == 1
    assert again.articles.unionByName(load.articles.select("md5", "id")).count() == 2


def test_incremental_load_keeps_the_rest_of_the_queue(spark, responses):
    queue = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "slug string")
    load = articles.ingest_incremental(queue, responses[1], responses[0], empty_store(spark), BASE, 2, 1, AT)
    assert load.queue.count() == 1
    assert load.articles.count() == 0  # no column is known
    assert set(load.queue.columns) == {"slug"}


def members_url(slug, page, kind="follow"):
    return [
        api.replace("{slug}", slug).replace("{offset}", str(20 * page))
        for api in paging.SEEDS[kind].values()
    ]


def test_only_owners_of_whole_chains_are_done(spark):
    def body(*slugs, after=None):
        data = [{"id": s, "url_token": s, "name": s} for s in slugs]
        return json.dumps({"paging": {"is_end": after is None, "next": after}, "data": data})

    def pages(slug, *members, cut=False):
        first, second = members_url(slug, 0), members_url(slug, 1)
        rows = [(first[0], body(*members, after=second[0]))]
        rows += [] if cut else [(second[0], body())]
        return [*rows, (first[1], body(""))]

    rows = pages("a", "b", "c") + pages("b", cut=True) + pages("a", "b", "c")  # a twice
    frame = [(i, url, text) for i, (url, text) in enumerate(rows)]
    frame.append((99, members_url("c", 0)[0], '{"paging": {"is_'))
    users = spark.createDataFrame([], schemas.USER)
    users = users.unionByName(
        spark.createDataFrame([("a", 1, False)], "slug string, id long, crawl_follow boolean"),
        allowMissingColumns=True,
    )
    responses = spark.createDataFrame(frame, schemas.RESPONSE)
    fresh, state, rejects = crawls.crawl_follow_graph(runtime.materialize(users, "u"), responses, AT)
    assert {r.slug for r in fresh.collect()} == {"b", "c"}
    assert {r.slug: r.crawl_follow for r in state.collect()} == {"a": True, "b": False, "c": False}
    reasons = sorted((r.resp_seq, r.reject_reason) for r in rejects.collect())
    assert reasons == [(2, "no_key"), (4, "no_key"), (99, "broken_body")]


def test_null_keys_are_told(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "key string, seq long")
    none = df.filter("false")
    assert [r.key for r in keyed.insert_if_absent(none, df, "key", ["seq"]).collect()] == ["a"]
    assert keyed.without_key(df, "key").select("seq", "reject_reason").collect() == [(2, "no_key")]


def test_snapshots(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "a long"
    one = spark.createDataFrame([(1,)], schema)
    assert tables.read_snapshot(spark, path, one.schema).count() == 0
    tables.write_snapshot(one, path, 3)
    tables.write_snapshot(one.union(one), path, 4)
    assert tables.read_snapshot(spark, path, one.schema).count() == 2
    (tmp_path / "t" / "snapshot=4" / "_SUCCESS").unlink()  # an unfinished write
    assert tables.read_snapshot(spark, path, one.schema).columns == ["a"]
    assert tables.newest_snapshot(spark, path) == 3


def test_bodies_are_parsed_once(spark, no_broadcast, responses, monkeypatch):
    plans = []
    plain = runtime.materialize

    def noted(df, tag):
        if tag == "posts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, tag)

    monkeypatch.setattr(runtime, "materialize", noted)
    articles.ingest_articles(*responses, empty_store(spark), BASE, AT)
    assert len(plans) == 1
    # A project that uses the parsed body names it; the parse itself stands in one generate.
    assert sum("Generate" in line and "from_json" in line for line in plans[0].split("\n")) <= 2


def test_a_session_without_a_shared_folder_is_told():
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )
    with pytest.raises(RuntimeError):
        runtime.shared_dir(unset)


def test_random_discovery_reads_planned_responses_only(spark):
    starts = spark.createDataFrame([(1,)], "k long")
    plan = runtime.materialize(paging.random_plan(starts, "k", 3, 1), "plan")
    first = plan.orderBy("draw").first().url
    body = json.dumps([{"slug": "x"}, {}])
    rows = [(1, first, body), (2, "https://elsewhere.example", json.dumps([{"slug": "y"}]))]
    empty = spark.createDataFrame([], schemas.RANDOM_COLUMN)
    known = spark.createDataFrame([], "slug string")
    fresh, rejects = crawls.discover_random_columns(
        spark.createDataFrame(rows, schemas.RESPONSE), known, empty, AT, plan
    )
    assert [r.slug for r in fresh.collect()] == ["x"]
    assert [(r.resp_seq, r.reject_reason) for r in rejects.collect()] == [(1, "no_key")]


def test_queue_after_a_run(spark):
    queue = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string")
    seen = spark.createDataFrame([("a", 404), ("b", 200)], "slug string, status int")
    assert [r.slug for r in articles.fetchable(queue, seen, seen.filter("status = 200")).collect()] == ["c"]

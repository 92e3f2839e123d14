"""A filter before an exact set never changes a result; later crawls skip finished users."""

import json
import re
from hashlib import md5

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.operators import paging, seen
from crawlmart.plans import articles, crawls
from crawlmart.plans.queries import QUERIES

AT = "2024-05-06 07:08:09"


def keys_of(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("u"), "id").alias("slug"))


def test_a_known_key_always_passes_the_filter(spark):
    known = seen.seen_keys(keys_of(spark, 0, 20000), "slug")
    assert known.n_blocks == 8
    assert known.maybe(keys_of(spark, 0, 20000)).filter("NOT _maybe").count() == 0
    assert known.maybe(keys_of(spark, 20000, 40000)).filter("_maybe").count() < 400


@pytest.mark.parametrize("n_blocks", [None, 1])
def test_unseen_is_an_anti_join(spark, n_blocks):
    """With one block for 20,000 keys nearly every key passes, and the result is the same."""
    known = seen.seen_keys(keys_of(spark, 0, 20000), "slug", n_blocks)
    rows = keys_of(spark, 19000, 22000).withColumn("n", F.monotonically_increasing_id())
    rows = runtime.materialize(rows.unionByName(rows), "rows")
    rest = known.unseen(rows, ["n"])
    assert rest.columns == ["slug", "n"]
    found = sorted(r.slug for r in rest.collect())
    assert found == sorted([f"u{i}" for i in range(20000, 22000)] * 2)


def test_one_key_with_most_rows(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(runtime, "ROWS_PER_TASK", 100)
    known = seen.seen_keys(keys_of(spark, 0, 20000), "slug", 1)
    rows = keys_of(spark, 19999, 20010).unionByName(
        spark.range(3000).select(F.lit("u20005").alias("slug"))
    )
    rows = runtime.materialize(rows.withColumn("n", F.monotonically_increasing_id()), "rows")
    assert known.unseen(rows, ["n"]).count() == 3010


def test_empty_null_and_repeated_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("", 3), ("b", 4), ("b", 4)], "slug string, n int")
    none = seen.seen_keys(rows.filter("false"), "slug")
    assert none.unseen(rows, ["n"]).count() == 5
    some = seen.seen_keys(spark.createDataFrame([("b",), ("b",), (None,), ("",)], "slug string"), "slug")
    assert sorted(r.n for r in some.unseen(rows, ["n"]).collect()) == [1, 2]
    assert some.unseen(rows.filter("false"), ["n"]).count() == 0


def test_rows_that_the_filter_settles_do_not_move(spark):
    known = seen.seen_keys(keys_of(spark, 0, 5000), "slug")
    rows = runtime.materialize(keys_of(spark, 4000, 9000).withColumn("body", F.lit("x" * 50)), "rows")
    plan = known.unseen(rows, ["body"])._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if re.search(r"Exchange (hash|range|RoundRobin)", x)]
    assert not moved, moved


def follow_pages(rows):
    """Both first pages of each user, each its chain's last."""
    out = []
    for user, members in rows:
        for api in paging.SEEDS["follow"].values():
            url = api.replace("{slug}", user).replace("{offset}", "0")
            data = [{"id": m, "url_token": m, "name": m} for m in members]
            out.append((len(out), url, json.dumps({"paging": {"is_end": True}, "data": data})))
    return out


def test_a_later_run_ends_where_one_run_ends(spark):
    pages = follow_pages([("a", ["b", "c"]), ("b", ["d"]), ("c", ["a"]), ("d", ["e"]), ("x", ["y"])])
    responses = spark.createDataFrame(pages, schemas.RESPONSE)
    users = spark.createDataFrame([], schemas.USER).unionByName(
        spark.createDataFrame([("a", 1, False)], "slug string, id long, crawl_follow boolean"),
        allowMissingColumns=True,
    )
    users = runtime.materialize(users, "users")
    state = lambda df: sorted((r.slug, r.crawl_follow) for r in df.collect())
    _, once, _ = crawls.crawl_follow_graph(users, responses, AT)
    _, first, _ = crawls.crawl_follow_graph(users, responses.filter("resp_seq < 4"), AT)
    first = runtime.materialize(first, "first")
    assert state(first) == [("a", True), ("b", True), ("c", False), ("d", False)]
    rest = crawls.unseen_responses(responses, crawls.finished_users(first, "crawl_follow"))
    assert sorted(r.resp_seq for r in rest.collect()) == [4, 5, 6, 7, 8, 9]
    fresh, second, _ = crawls.resume_follow_crawl(first, responses, AT)
    assert [r.slug for r in fresh.collect()] == ["e"]
    assert state(second) == state(once)
    ids = [r.id for r in second.collect()]
    assert len(set(ids)) == len(ids)


def test_a_queue_keeps_what_did_not_answer(spark):
    slugs = ["gone", "silent", "loaded", "known", "empty"]
    queue = spark.createDataFrame([(s,) for s in slugs], "slug string")
    statuses = spark.createDataFrame(
        [("gone", 404), ("silent", 503), ("loaded", 503), ("loaded", 200), ("known", 200), ("empty", 200)],
        "slug string, status int",
    )
    info = [
        (i, paging.COLUMN_API.replace("{slug}", s), json.dumps({"slug": s, "name": s, "postsCount": 1}))
        for i, s in enumerate(slugs)
    ]
    user = {"slug": "a", "name": "a", "hash": "a"}
    posts = [
        (i, paging.POSTS_API.replace("{slug}", s).replace("{offset}", "0"), json.dumps([
            {"slug": f"p{i}", "title": "t", "content": "c", "author": user,
             "publishedTime": "2024-01-02T03:04:05+08:00"}]))
        for i, s in enumerate(slugs[:4])
    ]
    make = lambda df: runtime.materialize(df, "store")
    columns = spark.createDataFrame([], schemas.COLUMN).unionByName(
        spark.createDataFrame([("known", 1, md5(b"known").hexdigest())], "slug string, id long, hash string"),
        allowMissingColumns=True,
    )
    store = articles.Store(
        make(spark.createDataFrame([], schemas.USER)), make(columns),
        make(spark.createDataFrame([], "md5 string, id long")),
    )
    load, left = articles.ingest_queue(
        queue, statuses, spark.createDataFrame(posts, schemas.RESPONSE),
        spark.createDataFrame(info, schemas.RESPONSE), store, "https://reader.example", AT,
    )
    assert [r.slug for r in load.columns.collect()] == ["loaded"]
    assert load.articles.count() == 4
    assert sorted(r.slug for r in left.collect()) == ["empty", "silent"]


def _events(tmp_path):
    """Events of 40 users, each of whom follows some of the next."""
    folder = tmp_path / "tables"
    folder.mkdir()
    rows = [(n, n % 40, json.dumps({"k": n * 7 % 23})) for n in range(300)]
    table = {"event_id": [r[0] for r in rows], "user_id": [r[1] for r in rows], "props": [r[2] for r in rows]}
    pq.write_table(pa.table(table), folder / "events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["crawl_follow_graph_resumed", "crawl_follow_graph", "discover_columns", "unseen_responses"])
def test_a_crawl_makes_its_pages_once(spark, tmp_path, monkeypatch, name):
    """Of all that a query writes and returns one plan alone builds the bodies, and none but
    those of a resumed crawl's rest and its alarms ask the filter."""
    plans = []
    real, counted = runtime.materialize, runtime.write_counted

    def plan_of(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return df

    monkeypatch.setattr(runtime, "materialize", lambda df, tag: real(plan_of(df), tag))
    monkeypatch.setattr(runtime, "write_counted", lambda df, path: counted(plan_of(df), path))
    plan_of(QUERIES[name](spark, _events(tmp_path))).collect()
    assert sum("to_json" in plan for plan in plans) == 1
    if name == "crawl_follow_graph_resumed":
        assert sum("getbit" in plan for plan in plans) == 2

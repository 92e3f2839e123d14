"""Extraction from broken, empty and odd responses."""

import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from crawlmart import schemas
from crawlmart.functions import keys
from crawlmart.operators import extract
from crawlmart.plans.articles import column_info

AUTHOR = {"uid": "1", "name": "n", "profileUrl": "p", "hash": "h", "slug": "s", "description": "d",
          "headline": "x", "avatar": {"id": "a", "template": None}}


def post(slug, **more):
    return {"slug": slug, "title": "t", "content": "c", "summary": "", "titleImage": "",
            "publishedTime": "2017-05-30T17:08:09+08:00", "author": AUTHOR, **more}


def responses(spark, bodies):
    rows = [(i, f"https://x/api/columns/col/posts?limit=20&offset={20 * i}", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, schemas.RESPONSE)


def test_posts(spark):
    bodies = [
        json.dumps([post("a"), post("a"), post(None)]),
        "[]",
        '[{"slug": "b"',
        None,
        json.dumps([post("c", publishedTime="2017-05-30T17:08:09Z"), post("d", author=None)]),
    ]
    df = responses(spark, bodies)
    broken = extract.broken_bodies(df, schemas.POSTS).select("resp_seq", "reject_reason").collect()
    assert sorted(r.resp_seq for r in broken) == [2, 3]
    seen = Observation()
    rows, rejects = extract.split_rejects(extract.explode_posts(df), extract.post_rejects(), seen)
    assert [(r.token, r.offset, r.column_slug) for r in rows.collect()] == [("a", 0, "col")] * 2
    assert seen.get == {"rows_in": 5, "no_key": 1, "no_author": 1, "bad_time": 1}
    assert sorted((r.token or "", r.reject_reason) for r in rejects.collect()) == [
        ("", "no_key"), ("c", "bad_time"), ("d", "no_author")]
    author = rows.first().author
    assert author.zuid == "1" and author.avatar == keys.USER_AVATAR.format(id="a", size="l")


def test_members_without_data_or_end(spark):
    bodies = [
        '{"paging": {"is_end": true}}',
        '{"paging": {"is_end": true}, "data": []}',
        '{"paging": {"next": "u2"}, "data": [{"id": "1", "url_token": "s", "name": "n"}]}',
        '{"paging": {"is_end": false, "next": "u3"}, "data": [{"url_token": null}]}',
        '{"paging": ',
    ]
    df = responses(spark, bodies)
    rows = extract.explode_members(df).orderBy("resp_seq").collect()
    assert [(r.slug, r.description) for r in rows] == [("s", ""), (None, "")]
    assert rows[1].hash is None and rows[1].link is None
    assert sorted(r.next_url for r in extract.paging(df).collect()) == ["u2", "u3"]
    assert [r.resp_seq for r in extract.broken_bodies(df, schemas.MEMBERS).collect()] == [4]


def test_columns_and_recommendations(spark):
    info = responses(spark, [
        json.dumps({"slug": "c", "name": "n", "postsCount": 41, "avatar": {"id": "i"}, "creator": None}),
        json.dumps({"slug": "d", "avatar": {"id": "i", "template": "t/{id}"}, "creator": {**AUTHOR, "bio": "b"}}),
        json.dumps({"slug": "c", "name": "later"}),
        "nonsense",
    ])
    rows = {r.slug: r for r in column_info(info).collect()}
    assert rows["c"].total == 41 and rows["c"].creator is None and rows["c"].name == "n"
    assert rows["c"].avatar == keys.COLUMN_AVATAR.format(id="i", size="l")
    assert rows["d"].total == 0 and rows["d"].creator.headline == "b" and rows["d"].avatar == "t/i"
    listed = extract.explode_recommendations(responses(spark, ['[{"slug": "a"}, {}, {"slug": ""}]', "{"]))
    assert [r.slug for r in listed.orderBy("pos").collect()] == ["a", "", ""]
    own = extract.explode_contributions(responses(spark, ['{"data": [{"column": {"id": "k"}}, {}]}']))
    assert [r.slug for r in own.orderBy("pos").collect()] == ["k", None]


def state_page(state, element="preloadedState"):
    text = state if isinstance(state, str) else json.dumps(state)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = text.replace(plain, entity)
    return f'<html><textarea id="{element}" hidden="">{text}</textarea></html>'


def test_states(spark):
    user = {"uid": "9", "slug": "u", "hash": "h", "avatarUrl": "v"}
    two = {"database": {"Post": {"b": {"slug": "b"}, "a": {"slug": "a", "author": "u", "content": "<p>&lt;",
           "column": {"slug": "c"}, "topics": [{"name": "x"}, {"name": "y"}]}}, "User": {"u": user}}}
    lost = {"database": {"Post": {"a": {"slug": "a", "author": "nobody"}}, "User": {}}}
    dated = '{"database":{"Post":{"q":{"slug":"q","updated":new D("1"),"canComment":1,"title":"new D(\\"1\\")"}},"User":{}}}'
    pages = [
        "<html>no state</html>", state_page(two), state_page(lost), state_page(dated),
        state_page("{broken"), state_page({"database": {"Post": {}, "User": {}}}), state_page(two, "other"),
    ]
    df = spark.createDataFrame([(i, "u", 200, h) for i, h in enumerate(pages)], schemas.PAGE)
    parsed = extract.embedded_json(df, "html", "preloadedState", schemas.POST_STATE, extract.repair_state)
    usable, rejects = extract.split_rejects(parsed, extract.state_rejects())
    assert sorted((r.page_id, r.reject_reason) for r in rejects.collect()) == [
        (0, "no_state"), (4, "broken_state"), (5, "no_post"), (6, "no_state")]
    rows = {r.resp_seq: r for r in extract.flatten_post_state(usable).collect()}
    assert rows[1].token == "a" and rows[1].author.avatar == "v" and rows[1].content == "<p>&lt;"
    assert rows[1].column_slug == "c" and rows[2].author is None and rows[2].column_slug is None
    assert rows[3].title == 'new D("1")'
    tags = extract.explode_tags(extract.flatten_post_state(usable)).collect()
    assert sorted((r.resp_seq, r.name) for r in tags) == [(1, "x"), (1, "y")]


def test_client_config(spark):
    page = state_page({"tokens": {"Authorization": "o 1"}}, "clientConfig")
    df = spark.createDataFrame([(1, "u", 200, page)], schemas.PAGE)
    row = extract.embedded_json(df, "html", "clientConfig", schemas.CLIENT_CONFIG).first()
    assert row.data.tokens == {"Authorization": "o 1"}


def test_table_rows(spark):
    head = "<tr><th>h</th><th>p</th><th>t</th></tr>"
    pages = [
        f"<table>{head}</table>",
        f"<table>{head}<tr><td>only</td></tr><tr class='o'><td>\n h1 </td><td>80</td><td><b>x</b></td></tr></table>",
        f"<table>{head}<TR><TD>h2<TD><img src='f.png'/>81<TD> http <i>s</i><tr><td></td><td>1</td><td>2</td></table>",
        "<p>no table</p>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    rows = extract.html_table_rows(df, "html", {"host": 1, "port": 2, "protocol": 3})
    got = sorted(tuple(r) for r in rows.select("page_id", "pos", "host", "port", "protocol").collect())
    assert got == sorted([
        (1, 0, "only", None, None), (1, 1, "h1", "80", None),
        (2, 0, "h2", "81", "http"), (2, 1, None, "1", "2"),
    ], key=lambda r: r[:2])


def test_repair_touches_its_place_only(spark):
    df = spark.createDataFrame([('{"a":"BAD","updated":BAD,"canComment":1}',)], "t string")
    got = df.select(extract.repair_state(F.col("t"))).first()[0]
    assert json.loads(got) == {"a": "BAD", "updated": " ", "canComment": 1}

"""Page plans, chains, cut-offs and the frontier against small brute-force versions."""

import random

import pytest

from crawlmart.operators import frontier, paging, summaries

TOTALS = [0, 1, 19, 20, 21, 40, 45, 400_021]


def offsets(total):
    """The next page is asked for while the offset just read is below the total."""
    seen, at = [0], 0
    while at < total:
        at += 20
        seen.append(at)
    return seen


def test_offset_plan(spark):
    df = spark.createDataFrame([(f"c{t}", t) for t in TOTALS] + [("none", None)], "slug string, total int")
    got = {}
    for row in paging.offset_plan(df).collect():
        got.setdefault(row.slug, []).append(row.offset)
    assert {k: sorted(v) for k, v in got.items()} == {**{f"c{t}": offsets(t) for t in TOTALS}, "none": [0]}


def chains(starts, links):
    found = set()
    for start in starts:
        at, hop, seen = start, 0, set()
        while at is not None and at not in seen:
            seen.add(at)
            found.add((start, at, hop))
            at, hop = links.get(at), hop + 1
    return found


@pytest.mark.parametrize("broadcast", [True, False])
def test_cursor_pages(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    links = {f"a{i}": f"a{i + 1}" for i in range(37)}
    links |= {"self": "self", "c0": "c1", "c1": "c2", "c2": "c3", "c3": "c1", "b": "a30"}
    starts = ["a0", "self", "c0", "b", "lonely"]
    df = spark.createDataFrame(list(links.items()), "url string, next_url string")
    got = paging.cursor_pages(spark.createDataFrame([(s,) for s in starts], "url string"), df)
    assert {tuple(r) for r in got.select("root", "url", "hop").collect()} == chains(starts, links)
    assert got.count() == len(chains(starts, links))


def levels(edges, seeds):
    depth, level, at = {s: 0 for s in seeds}, set(seeds), 0
    while level:
        at += 1
        level = {d for s, d in edges if s in level} - set(depth)
        depth |= {d: at for d in level}
    return depth


@pytest.mark.parametrize("broadcast", [True, False])
def test_expand_frontier(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(1)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("z", "y"), ("c", "d"), ("e", "d"), ("d", "f")]
    edges += [("hub", f"n{i}") for i in range(200)] + [("d", "hub")]
    edges += [(f"n{rng.randrange(200)}", f"m{rng.randrange(300)}") for _ in range(200)]
    df = spark.createDataFrame(edges * 2, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("e",), ("e",)], "user string")
    got = frontier.expand_frontier(df, seeds).collect()
    assert {r.user: r.depth for r in got} == levels(edges, ["a", "e"])
    assert len(got) == len(levels(edges, ["a", "e"]))
    near = frontier.expand_frontier(df, seeds, max_depth=1).collect()
    assert {r.user for r in near} == {u for u, d in levels(edges, ["a", "e"]).items() if d <= 1}


@pytest.mark.parametrize("broadcast", [True, False])
def test_until_first_seen(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    posts = [(c, p, f"{c}{p}{i}") for c in "ab" for p in range(5) for i in range(3)]
    known = ["a21", "a40", "zzz"]
    df = spark.createDataFrame(posts, "column_slug string, page int, md5 string")
    got = paging.until_first_seen(df, spark.createDataFrame([(k,) for k in known], "md5 string"))
    want = [p for p in posts if p[0] == "b" or p[1] <= 2]
    assert sorted(tuple(r) for r in got.select("column_slug", "page", "md5").collect()) == sorted(want)


def test_last_update(spark):
    columns = spark.createDataFrame(
        [("new", None), ("late", "2030-01-01 00:00:00"), ("early", "2000-01-01 00:00:00"), ("idle", None)],
        "slug string, t string").selectExpr("slug", "cast(t as timestamp_ntz) as last_update_time")
    posts = spark.createDataFrame(
        [(s, t) for s in ("new", "late", "early", "unknown")
         for t in ("2017-01-02T00:00:00+08:00", "2017-01-01T00:00:00+08:00", "2040-01-01T00:00:00Z")],
        "column_slug string, published string")
    got = {r.slug: str(r.last_update_time) for r in summaries.last_update_per_column(posts, columns).collect()}
    assert got == {"new": "2017-01-02 00:00:00", "late": "2030-01-01 00:00:00",
                   "early": "2017-01-02 00:00:00", "idle": "None"}


def test_random_plan_stays_in_range(spark):
    rows = paging.random_plan(spark.range(200), "id", 10, 3).collect()
    assert len(rows) == 2000
    assert {min(r.limit for r in rows), max(r.limit for r in rows)} == {13, 40}
    assert {min(r.offset for r in rows), max(r.offset for r in rows)} == {0, 100}
    again = paging.random_plan(spark.range(200).repartition(5), "id", 10, 3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))

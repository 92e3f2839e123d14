"""Crawl responses and stores derived from the general-purpose test tables.

Each view covers its whole table and has a fixed definition, so the same data can be
written down again in another SQL engine. Groups that are collected into one body have a
size bound of their own (a page of 20 posts, a page of 20 members, 100 proxies).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlmart import schemas
from crawlmart.functions import keys
from crawlmart.operators import extract, paging

PAGE_SIZE = 20
CHUNK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# -- posts and columns -----------------------------------------------------------------
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the time and user of the event of the same number, and their place
    ``rn`` in their source, newest first."""
    whole = table(spark, sf_dir, "documents")
    docs = whole.select("doc_id", "source", F.floor(F.col("doc_id") / CHUNK).alias("chunk"))
    # A source may hold any share of the documents: they are ranked inside chunks of
    # bounded size and shifted by the sizes of the newer chunks. Only the numbers are
    # moved for that; the texts join the ranks at the end.
    newer = Window.partitionBy("source").orderBy(F.desc("chunk")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        docs.groupBy("source", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("source", "chunk", F.coalesce(F.sum("n").over(newer), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("source", "chunk").orderBy(F.desc("doc_id"))
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts", "user_id")
    ranked = (
        docs.withColumn("_n", F.row_number().over(inside))
        .join(offsets, ["source", "chunk"])
        .select("doc_id", (F.col("before") + F.col("_n")).alias("rn"))
        .join(events, "doc_id")
    )
    return whole.select("doc_id", "text", "lang", "source", "n_chars").join(ranked, "doc_id").withColumn(
        "src_no", F.substring("source", 4, 18).cast("long")
    )


def _user(headline: str) -> Column:
    user = F.col("user_id")
    slug = _text("u", user)
    template = F.when(user % 5 != 0, F.lit("https://img.example/{id}_{size}.png"))
    return F.struct(
        user.cast("string").alias("uid"),
        _text("User ", user).alias("name"),
        _text("https://people.example/", slug).alias("profileUrl"),
        F.md5(slug).alias("hash"),
        slug.alias("slug"),
        _text("About ", slug).alias("description"),
        _text(headline[0], user).alias(headline),
        F.struct(_text("a", user).alias("id"), template.alias("template")).alias("avatar"),
    )


def content() -> Column:
    """The whole text as article HTML: an image in every second document, a link in all."""
    doc = F.col("doc_id")
    image = F.when(doc % 2 == 0, _text('<img alt="x" src="', doc, '.jpg">')).otherwise("")
    return _text(
        "<p>", F.col("text"), "</p>", image, '<a href="https://x.example/p/', doc, '?a=1">more</a>'
    )


def _cover() -> Column:
    return F.when(F.col("doc_id") % 3 == 0, F.lit("c.jpg")).otherwise("")


def _published() -> Column:
    return F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+08:00'")


def _post() -> Column:
    return F.struct(
        F.md5("text").alias("slug"),
        _text("Post ", F.col("doc_id")).alias("title"),
        content().alias("content"),
        _text(F.col("lang"), ":", F.col("n_chars")).alias("summary"),
        _cover().alias("titleImage"),
        _published().alias("publishedTime"),
        _user("headline").alias("author"),
    )


def _page_columns() -> dict[str, Column]:
    page = F.floor((F.col("rn") - 1) / PAGE_SIZE).cast("long")
    return {
        "page": page,
        "pos": ((F.col("rn") - 1) % PAGE_SIZE).cast("int"),
        # Pages of all columns arrive in turn: the newest page of each, then the next.
        "resp_seq": page * 2**20 + F.col("src_no"),
        "post": _post(),
    }


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows as ``explode_posts`` gives them, with ``page`` and ``doc_id``."""
    paged = documents(spark, sf_dir).withColumns(_page_columns())
    return paged.select(
        "resp_seq",
        "pos",
        F.col("source").alias("column_slug"),
        (F.col("page") * PAGE_SIZE).cast("int").alias("offset"),
        *extract.post_columns(F.col("post")),
        "page",
        "doc_id",
    )


def post_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of the posts API: one JSON list per column and page of 20 posts."""
    paged = documents(spark, sf_dir).withColumns(_page_columns())
    bodies = paged.groupBy("resp_seq", "source", "page").agg(
        F.sort_array(F.collect_list(F.struct("pos", "post"))).alias("rows")
    )
    url = paging.fill(
        paging.POSTS_API, slug=F.col("source"), offset=F.col("page") * PAGE_SIZE
    )
    return bodies.select("resp_seq", url.alias("url"), F.to_json("rows.post").alias("body"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source: number of documents, first document and its user."""
    docs = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")
    )
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "user_id")
    return docs.join(events, "doc_id").withColumn(
        "src_no", F.substring("source", 4, 18).cast("long")
    )


def column_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of the column API: one object per source. Every fifth has no template for
    its avatar, every seventh no creator."""
    template = F.when(F.col("src_no") % 5 != 0, F.lit("https://img.example/{id}_{size}.png"))
    info = F.struct(
        F.col("source").alias("slug"),
        _text("Column ", F.col("src_no")).alias("name"),
        _text("All of ", F.col("source")).alias("description"),
        F.col("n").cast("string").alias("postsCount"),
        F.struct(_text("c", F.col("src_no")).alias("id"), template.alias("template")).alias("avatar"),
        F.when(F.col("src_no") % 7 != 6, _user("bio")).alias("creator"),
    )
    return _sources(spark, sf_dir).select(
        F.col("src_no").alias("resp_seq"),
        paging.fill(paging.COLUMN_API, slug=F.col("source")).alias("url"),
        F.to_json(info).alias("body"),
    )


def column_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of the column API: some sources are gone, some do not answer."""
    no = F.col("src_no")
    status = F.when(no % 9 == 4, 404).when(no % 11 == 7, 503).otherwise(200)
    return _sources(spark, sf_dir).select(F.col("source").alias("slug"), status.alias("status"))


def recommendation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of recommended columns, 13 sources each; an item of every list has no slug."""
    item = F.struct(
        F.col("src_no"), F.struct(F.when(F.col("src_no") % 13 != 5, F.col("source")).alias("slug")).alias("c")
    )
    page = F.floor(F.col("src_no") / 13).cast("long")
    return (
        _sources(spark, sf_dir)
        .groupBy(page.alias("resp_seq"))
        .agg(F.sort_array(F.collect_list(item)).alias("rows"))
        .select(
            "resp_seq",
            paging.fill(
                paging.RANDOM_API, limit=F.lit(13), offset=F.col("resp_seq"), seed=F.lit(0)
            ).alias("url"),
            F.to_json("rows.c").alias("body"),
        )
    )


def page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML pages with an embedded post state, one per document, escaped, with a malformed
    "updated" value; every column without a creator is left out of its posts."""
    docs = documents(spark, sf_dir).withColumns({"post": _post(), "user": _user("headline")})
    post, user = F.col("post"), F.col("user")
    state_post = F.struct(
        *[post[n].alias(n) for n in ("slug", "title", "content", "summary", "titleImage", "publishedTime")],
        user["slug"].alias("author"),
        F.when(F.col("src_no") % 7 != 6, F.struct(F.col("source").alias("slug"))).alias("column"),
        F.array(
            F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))
        ).alias("topics"),
    )
    state_user = F.struct(
        *[user[n].alias(n) for n in ("uid", "name", "profileUrl", "hash", "slug", "description", "headline")],
        _text("https://img.example/", user["slug"]).alias("avatarUrl"),
    )
    # The broken part stands in front of the closing brace of the post, as site data does.
    post_json = F.regexp_replace(
        F.to_json(state_post), r"\}$", ',"updated":new Date("1"),"canComment":true}'
    )
    state = _text(
        '{"database":{"Post":{"', post["slug"], '":', post_json, '},"User":{"', user["slug"],
        '":', F.to_json(state_user), "}}}",
    )
    escaped = state
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    html = _text(
        '<html><body><textarea id="preloadedState" hidden="">', escaped, "</textarea></body></html>"
    )
    return docs.select(
        F.col("doc_id").alias("page_id"),
        _text("https://x.example/p/", F.col("doc_id")).alias("url"),
        F.lit(200).alias("status"),
        html.alias("html"),
    )


# -- stores ----------------------------------------------------------------------------
AT = "2020-01-01 00:00:00"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User table: every user of the events; flags by number, unknown for every seventh."""
    user = F.col("user_id")
    slug = _text("u", user)
    known = user % 7 != 0
    made = table(spark, sf_dir, "events").select("user_id").distinct()
    made = made.select(
        (user + 1).alias("id"),
        user.cast("string").alias("zuid"),
        _text("Stored ", user).alias("name"),
        keys.build_link("people", slug).alias("link"),
        F.md5(slug).alias("hash"),
        slug.alias("slug"),
        F.lit("").alias("description"),
        F.lit(None).cast("string").alias("headline"),
        F.lit(None).cast("string").alias("avatar"),
        F.when(known, user % 3 == 0).alias("crawl_column"),
        F.when(known, user % 2 == 0).alias("crawl_follow"),
    )
    return keys.stamp(made, AT).select(*schemas.USER.fieldNames())


def stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the users that an earlier crawl has stored."""
    return users(spark, sf_dir).filter((F.col("id") - 1) % 3 == 0)


def stored_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column table of an earlier crawl; half of its rows know a last update."""
    no = F.col("src_no")
    made = _sources(spark, sf_dir).filter(no % 4 == 0).select(
        (no + 1).alias("id"),
        _text("Column ", no).alias("name"),
        keys.build_link("column", F.col("source")).alias("link"),
        F.md5("source").alias("hash"),
        F.col("source").alias("slug"),
        F.lit("").alias("description"),
        F.lit(None).cast("string").alias("avatar"),
        F.lit(None).cast("long").alias("creator_id"),
        F.when(no % 8 == 0, F.lit("2024-01-01 00:00:00"))
        .when(no % 16 == 4, F.lit("2034-01-01 00:00:00"))
        .cast("timestamp_ntz")
        .alias("last_update_time"),
    )
    return keys.stamp(made, AT).select(*schemas.COLUMN.fieldNames())


def known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set of column slugs an earlier crawl knows."""
    return _sources(spark, sf_dir).filter(F.col("src_no") % 4 == 0).select(F.col("source").alias("slug"))


def column_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue of column slugs to crawl."""
    return _sources(spark, sf_dir).select(F.col("source").alias("slug"))


def _article_store(docs: DataFrame) -> DataFrame:
    # Copies of one text are one article: its id comes from the first copy.
    return docs.groupBy(F.md5(F.md5("text")).alias("md5")).agg(
        (F.min("doc_id") + 1).alias("id")
    )


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(md5, id) of the articles an earlier crawl has stored: every third document."""
    return _article_store(table(spark, sf_dir, "documents").filter(F.col("doc_id") % 3 == 0))


def old_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(md5, id) of the older half of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    half = docs.agg((F.count(F.lit(1)) / 2).alias("half")).scalar()
    return _article_store(docs.filter(F.col("doc_id") < half))


# -- follow graph ----------------------------------------------------------------------
def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, k) pairs of the events, at most 100 per user."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("user_id", k.alias("k")).distinct()


def follow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from each user to the user k numbers further on."""
    return follows(spark, sf_dir).select(
        _text("u", F.col("user_id")).alias("src"), _text("u", F.col("user_id") + F.col("k")).alias("dst")
    )


def _chained_pages(spark: SparkSession, sf_dir: str, apis: dict[str, str], item: dict[str, Column]) -> DataFrame:
    """API pages of up to 20 items per user and endpoint: even k on the first endpoint, odd
    k on the second, chained by ``paging.next``."""
    first, second = apis
    row = F.row_number().over(Window.partitionBy("user_id", "side").orderBy("k")) - 1
    template = F.when(F.col("side") == 0, F.lit(apis[first])).otherwise(F.lit(apis[second]))
    at = lambda page: F.replace(
        F.replace(template, F.lit("{slug}"), _text("u", F.col("user_id"))),
        F.lit("{offset}"),
        (page * PAGE_SIZE).cast("string"),
    )
    shaped = F.when(F.col("side") == 0, F.to_json(F.col("rows.a"))).otherwise(F.to_json(F.col("rows.b")))
    pages = (
        follows(spark, sf_dir)
        .withColumn("side", F.col("k") % 2)
        .withColumn("rn", row)
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id", "side")))
        .groupBy("user_id", "side", "n", F.floor(F.col("rn") / PAGE_SIZE).cast("long").alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("k", item[first].alias("a"), item[second].alias("b")))).alias("rows"))
    )
    is_end = (F.col("page") + 1) * PAGE_SIZE >= F.col("n")
    body = _text(
        '{"paging":',
        F.to_json(F.struct(is_end.alias("is_end"), F.when(~is_end, at(F.col("page") + 1)).alias("next"))),
        ',"data":', shaped, "}",
    )
    seq = (F.col("page") * 2 + F.col("side")) * 2**32 + F.col("user_id")
    return pages.select(seq.alias("resp_seq"), at(F.col("page")).alias("url"), body.alias("body"))


def follow_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follower and followee pages of every user."""
    other = F.col("user_id") + F.col("k")
    member = F.struct(
        other.cast("string").alias("id"),
        _text("Member ", other, " of ", F.col("user_id")).alias("name"),
        _text("u", other).alias("url_token"),
        _text("https://img.example/u", other).alias("avatar_url"),
        _text("h", other).alias("headline"),
    )
    apis = paging.SEEDS["follow"]
    return _chained_pages(spark, sf_dir, apis, {name: member for name in apis})


def user_column_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of contributed and followed columns of every user."""
    slug = _text("c", F.col("user_id") + F.col("k"))
    item = F.struct(slug.alias("id"))
    apis = paging.SEEDS["column"]
    return _chained_pages(
        spark, sf_dir, apis, {"contributions": F.struct(item.alias("column")), "following": item}
    )


def known_user_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set of the columns of ``user_column_responses`` whose number is divisible by 4."""
    number = F.col("user_id") + F.col("k")
    return follows(spark, sf_dir).filter(number % 4 == 0).select(_text("c", number).alias("slug")).distinct()


# -- paged API -------------------------------------------------------------------------
def paged_responses(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One page per turn of a conversation, an item per word of its text; the pages of a
    conversation are chained. ``kind``: members, contributions or following."""
    words = F.filter(F.split("text", "[ \n]+"), lambda w: w != "")
    shapes = {
        "members": lambda w, i: F.struct(
            _text(F.col("conv_id"), "-", F.col("turn"), "-", i).alias("id"),
            _text("Member ", w).alias("name"),
            w.alias("url_token"),
            _text("https://img.example/", w).alias("avatar_url"),
            F.col("role").alias("headline"),
        ),
        "contributions": lambda w, i: F.struct(F.struct(w.alias("id")).alias("column")),
        "following": lambda w, i: F.struct(w.alias("id")),
    }
    at = lambda turn: paging.fill(
        paging.FOLLOWERS_API, slug=_text("conv", F.col("conv_id")), offset=turn * PAGE_SIZE
    )
    talk = table(spark, sf_dir, "conversations")
    last = talk.groupBy("conv_id").agg(F.max("turn").alias("last"))
    is_end = F.col("turn") == F.col("last")
    body = F.struct(
        F.struct(is_end.alias("is_end"), F.when(~is_end, at(F.col("turn") + 1)).alias("next")).alias("paging"),
        F.transform(words, shapes[kind]).alias("data"),
    )
    return talk.join(last, "conv_id").select(
        (F.col("turn") * 2**32 + F.col("conv_id")).alias("resp_seq"),
        at(F.col("turn")).alias("url"),
        F.to_json(body).alias("body"),
    )


# -- proxies ---------------------------------------------------------------------------
def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        "s_nationkey",
        _text("10.0.", F.col("s_nationkey"), ".", key % 250).alias("host"),
        (key + 8000).cast("string").alias("port"),
        F.element_at(F.array(F.lit("HTTP"), F.lit("https"), F.lit("HTTPS")), (key % 3 + 1).cast("int")).alias("protocol"),
        F.when(key % 5 == 0, 404).otherwise(200).alias("status"),
        (F.abs("s_acctbal") / 2500).alias("elapsed"),
    )


def proxy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proxy lists in three layouts: a page per nation and 100 suppliers, a header row, a
    row per supplier with blanks around the cell texts."""
    cell = lambda text: _text("<td> ", text, "\n</td>")
    pad = F.lit("<td>-</td>")
    layout = F.col("s_nationkey") % 3
    host, port, protocol = cell(F.col("host")), cell(F.col("port")), cell(F.col("protocol"))
    row = (
        F.when(layout == 0, F.concat(pad, host, port, pad, pad, protocol))
        .when(layout == 1, F.concat(host, port, pad, protocol))
        .otherwise(F.concat(host, port, pad, pad, protocol))
    )
    page = F.floor(F.col("s_suppkey") / 100).cast("long")
    return (
        _supplier(spark, sf_dir)
        .withColumn("row", _text('<tr class="r">', row, "</tr>"))
        .groupBy("s_nationkey", page.alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "row"))).alias("rows"))
        .select(
            (F.col("page") * 1000 + F.col("s_nationkey")).alias("page_id"),
            F.element_at(F.array(*[F.lit(n) for n in extract.PROXY_LAYOUTS]), (layout + 1).cast("int")).alias("layout"),
            F.lit(200).alias("status"),
            _text(
                "<table><tr><th>host</th></tr>\n", F.array_join("rows.row", "\n"), "</table>"
            ).alias("html"),
        )
    )


def proxy_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of a test fetch through every proxy."""
    return _supplier(spark, sf_dir).select("host", "port", "status", "elapsed")


def stored_proxies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proxy table of an earlier crawl: one row per host of the even nations, switched off."""
    made = (
        _supplier(spark, sf_dir)
        .filter(F.col("s_nationkey") % 2 == 0)
        .groupBy("host")
        .agg(F.min("s_suppkey").alias("k"))
        .select(
            (F.col("k") + 1).alias("id"),
            "host",
            F.lit(1).alias("port"),
            F.lit(2).alias("protocol"),
            F.lit(False).alias("available"),
        )
    )
    return keys.stamp(made, AT).select(*schemas.PROXY.fieldNames())


# -- HTML and streams ------------------------------------------------------------------
def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as article HTML with a cover; an image on every second, a link on all."""
    page = F.col("page_id")
    image = F.when(page % 2 == 0, _text('<img src="', page, '.jpg">')).otherwise("")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        _text(F.col("html"), image, '<a href="https://x.example/p/', page, '?a=1">').alias("html"),
        F.when(page % 3 == 0, F.lit("c.jpg")).otherwise("").alias("cover"),
    )


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as keyed items: key ``<user>-<k>``, arrival order event_id."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        _text("u", F.col("user_id")).alias("slug"),
        F.concat_ws("-", "user_id", k).alias("key"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def event_arrivals(spark: SparkSession, sf_dir: str, parts: int = 4) -> list[DataFrame]:
    """The event items in ``parts`` consecutive ranges, as they would land one by one."""
    items = event_items(spark, sf_dir)
    top = items.agg(F.max("seq")).first()[0]
    size = top // parts + 1
    return [items.filter(F.col("seq").between(i * size, (i + 1) * size - 1)) for i in range(parts)]

"""One named query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.functions import html, keys
from crawlmart.operators import extract, frontier, keyed, paging, star, summaries
from crawlmart.operators.extract import SEQ
from crawlmart.plans import articles, crawls
from crawlmart.sources import ids, keyed_store, sample, tables
from crawlmart.streaming import commits, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE = "https://reader.example"
AT = sample.AT
DRAWN, SEED, COMMIT = 10, 7, 100


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def text_of(col: str | Column) -> Column:
    """Timestamps as text, to second precision."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def flat(name: str) -> list[Column]:
    return [F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in star.USER_FIELDS]


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def store(spark: SparkSession, sf: str, known: Query = sample.stored_articles) -> articles.Store:
    """What an earlier crawl has stored, as written tables."""
    return articles.Store(
        runtime.materialize(sample.stored_users(spark, sf), "users"),
        runtime.materialize(sample.stored_columns(spark, sf), "columns"),
        runtime.materialize(known(spark, sf), "articles"),
    )


def keyed_stores(spark: SparkSession, sf: str, known: Query = sample.stored_articles) -> articles.KeyedStores:
    """The same in stores by key hash, with a ledger of ids that knows the stored ones."""
    plain, root = store(spark, sf, known), runtime.new_dir(spark, "stores")
    ledger = ids.IdLedger(spark, f"{root}/ids")
    for name in ("users", "columns", "articles"):
        top = summaries.max_id(getattr(plain, name)).first()["max_id"]
        ledger.reserve(name, "", top)
    users = keyed_store.KeyedStore(spark, f"{root}/users", "slug", schemas.USER, 1)
    stored = keyed_store.KeyedStore(spark, f"{root}/articles", "md5", plain.articles.schema, 1)
    users.write(plain.users, 0)
    stored.write(plain.articles, 0)
    return articles.KeyedStores(users, plain.columns, stored, ledger, "load")


# -- sources and sinks -----------------------------------------------------------------
@query
def read_pages(spark, sf):
    return tables.read_pages(spark, f"{sf}/pages.parquet")


@query
def read_api(spark, sf):
    path = runtime.new_dir(spark, "responses")
    sample.paged_responses(spark, sf, "members").write.parquet(path)
    responses = tables.read_api(spark, path)
    body = F.from_json("body", schemas.MEMBERS)
    return responses.select("url", F.explode(F.array(body)).alias("b")).select(
        "url", F.size("b.data").alias("n_rows"), F.col("b.paging.is_end").alias("is_end")
    )


@query
def read_store(spark, sf):
    path = runtime.new_dir(spark, "users")
    stored = sample.users(spark, sf)
    odd = F.col("id") % 2 == 1
    tables.write_table(stored.filter(odd), path, 0)
    tables.write_table(stored.filter(~odd), path, 1)
    rows = tables.read_store(spark, path, schemas.USER)
    return rows.select("id", "slug", "hash", "crawl_follow", text_of("create_time").alias("created"))


@query
def set_members(spark, sf):
    return tables.add_to_set(sample.known_columns(spark, sf), sample.column_queue(spark, sf))


@query
def write_star(spark, sf):
    posts = sample.posts(spark, sf)
    users, columns = sample.users(spark, sf), sample.stored_columns(spark, sf)
    fact = star.load_fact(posts, users, columns).select("md5", "title", "author_id", "belong_id")
    root = runtime.new_dir(spark, "star")
    tables.write_star({"user": users, "column": columns}, {"article": fact}, root, 0)
    facts = tables.read_star(spark, root, "article", fact.schema)
    names = tables.read_star(spark, root, "user", schemas.USER)
    names = names.select(F.col("id").alias("author_id"), F.col("name").alias("author"))
    return runtime.lookup(facts, names, "author_id", ["title"]).select(
        "md5", "title", "author", "belong_id"
    )


# -- extraction ------------------------------------------------------------------------
@query
def html_table_rows(spark, sf):
    rows = extract.html_table_rows(
        sample.proxy_pages(spark, sf), "html", extract.layout_columns("layout")
    )
    return rows.select("page_id", "pos", "host", "port", "protocol")


@query
def html_table_rows_nested(spark, sf):
    """Each cell without a value holds a table of its own."""
    inner = "<td>a<table><tr><td> in\n</td><td><b>x</b>side</td></tr></table>b</td>"
    pages = sample.proxy_pages(spark, sf).withColumn("html", F.replace("html", F.lit("<td>-</td>"), F.lit(inner)))
    return extract.html_table_rows_nested(pages, "html", extract.layout_columns("layout"), "page_id")


@query
def embedded_json(spark, sf):
    states = extract.embedded_json(
        sample.page_states(spark, sf), "html", "preloadedState", schemas.POST_STATE, extract.repair_state
    )
    return states.select(
        "page_id",
        F.array_join(F.map_keys("data.database.Post"), ",").alias("tokens"),
        F.array_join(F.map_keys("data.database.User"), ",").alias("slugs"),
        F.col("data._corrupt").isNotNull().alias("broken"),
    )


@query
def repair_json_field(spark, sf):
    bad = F.concat(
        F.lit('{"id":'), F.col("doc_id"), F.lit(',"updated":'), F.col("source"), F.lit(',"canComment":true}')
    )
    return sample.table(spark, sf, "documents").select(
        "doc_id", extract.repair_state(bad).alias("fixed")
    )


@query
def flatten_post_state(spark, sf):
    states = extract.embedded_json(
        sample.page_states(spark, sf), "html", "preloadedState", schemas.POST_STATE, extract.repair_state
    )
    rows = extract.flatten_post_state(states)
    return rows.select(
        F.col("resp_seq").alias("page_id"), "column_slug", "title", "content", "summary", "cover",
        "token", "md5", "link", "published", *flat("author"),
    )


@query
def explode_posts(spark, sf):
    rows = extract.explode_posts(sample.post_responses(spark, sf))
    return rows.select(
        "resp_seq", "pos", "column_slug", "offset", "title", "content", "summary", "cover",
        "token", "md5", "link", "published", *flat("author"),
    )


@query
def explode_members(spark, sf):
    return extract.explode_members(sample.paged_responses(spark, sf, "members"))


@query
def explode_contributions(spark, sf):
    return extract.explode_contributions(sample.paged_responses(spark, sf, "contributions"))


@query
def explode_following_columns(spark, sf):
    return extract.explode_following_columns(sample.paged_responses(spark, sf, "following"))


@query
def explode_recommendations(spark, sf):
    return extract.explode_recommendations(sample.recommendation_responses(spark, sf))


@query
def flatten_column_info(spark, sf):
    rows = extract.flatten_column_info(sample.column_responses(spark, sf))
    return rows.select(
        "slug", "name", "link", "hash", "description", "avatar", "total", *flat("creator")
    )


@query
def explode_tags(spark, sf):
    states = extract.embedded_json(
        sample.page_states(spark, sf), "html", "preloadedState", schemas.POST_STATE, extract.repair_state
    )
    return extract.explode_tags(extract.flatten_post_state(states)).select(
        F.col("resp_seq").alias("page_id"), "pos", "md5", "name"
    )


# -- scalar functions ------------------------------------------------------------------
@query
def md5_key(spark, sf):
    docs = sample.table(spark, sf, "documents")
    return docs.select(
        "doc_id", keys.md5_key(F.col("text")).alias("text_key"), keys.md5_key(F.col("doc_id")).alias("id_key")
    )


@query
def build_link(spark, sf):
    users = sample.users(spark, sf)
    return users.select("slug", *[keys.build_link(k, F.col("slug")).alias(k) for k in keys.LINKS])


@query
def avatar_url(spark, sf):
    users = sample.users(spark, sf)
    template = F.when(F.col("id") % 2 == 0, F.lit("https://img.example/{size}/{id}.png"))
    return users.select(
        "slug",
        keys.avatar_url(template, F.col("hash")).alias("large"),
        keys.avatar_url(template, F.col("hash"), "s", keys.COLUMN_AVATAR).alias("small"),
    )


@query
def slug_from_url(spark, sf):
    return sample.table(spark, sf, "pages").select(
        "page_id", keys.slug_from_url(F.col("url")).alias("slug")
    )


@query
def offset_from_url(spark, sf):
    pages = sample.paged_responses(spark, sf, "members")
    return pages.select("url", keys.offset_from_url(F.col("url")).alias("offset"))


@query
def parse_published(spark, sf):
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.element_at(
        F.array(F.lit("+08:00"), F.lit("Z"), F.lit("+09:00")), (F.col("event_id") % 3 + 1).cast("int")
    )
    events = sample.table(spark, sf, "events").withColumn("published", F.concat(wall, zone))
    return events.select(
        "event_id", "published", text_of(keys.parse_published(F.col("published"))).alias("wall_clock")
    )


def proxy_rows(spark, sf):
    return html_table_rows(spark, sf).withColumnRenamed("page_id", "resp_seq")


@query
def encode_protocol(spark, sf):
    return proxy_rows(spark, sf).select(
        "host", "port", "protocol", keys.encode_protocol(F.col("protocol")).alias("code")
    )


@query
def decode_choice(spark, sf):
    code = (F.col("s_suppkey") % 4).cast("int")
    return sample.table(spark, sf, "supplier").select(
        "s_suppkey",
        keys.decode_choice(code).alias("name"),
        F.array_contains(keys.choice_values(), code).alias("is_choice"),
    )


@query
def proxy_address(spark, sf):
    address = keys.proxy_address(F.col("protocol"), F.col("host"), F.col("port"))
    return proxy_rows(spark, sf).select(F.explode(address).alias("scheme", "address"))


@query
def with_defaults(spark, sf):
    rows = extract.flatten_column_info(sample.column_responses(spark, sf)).select(
        "slug", F.nullif("total", F.lit(0)).alias("total"), F.col("creator.name").alias("creator_name")
    )
    return keys.with_defaults(rows, {"total": 0, "creator_name": "nobody"})


@query
def stamp(spark, sf):
    rows = keys.stamp(sample.users(spark, sf).select("slug"), "2024-05-06 07:08:09")
    return rows.select(
        "slug", text_of("create_time").alias("created"), text_of("modify_time").alias("modified")
    )


@query
def html_unescape(spark, sf):
    return sample.table(spark, sf, "pages").select(
        "page_id", html.html_unescape(F.col("html")).alias("text")
    )


@query
def rewrite_images(spark, sf):
    return sample.article_pages(spark, sf).select(
        "page_id", html.rewrite_images(F.col("html")).alias("html")
    )


@query
def cover_or_first_image(spark, sf):
    return sample.article_pages(spark, sf).select(
        "page_id", html.cover_or_first_image(F.col("cover"), F.col("html")).alias("cover")
    )


@query
def rewrite_article_links(spark, sf):
    return sample.article_pages(spark, sf).select(
        "page_id", html.rewrite_article_links(F.col("html"), BASE).alias("html")
    )


# -- filters ---------------------------------------------------------------------------
@query
def available_proxies(spark, sf):
    rows = keyed.available(
        proxy_rows(spark, sf), sample.proxy_checks(spark, sf), ["host", "port"], SEQ
    )
    return rows.select("host", "port", "protocol")


@query
def dead_links(spark, sf):
    checks = sample.proxy_checks(spark, sf)
    return keyed.dead_links(checks.select("host").distinct(), checks, "host")


@query
def pending_users(spark, sf):
    return keyed.pending(sample.users(spark, sf), "crawl_follow").select("slug", "id")


@query
def non_empty_key(spark, sf):
    rows = extract.explode_recommendations(sample.recommendation_responses(spark, sf))
    return keyed.non_empty_key(rows, "slug").select("resp_seq", "pos", "slug", "hash")


@query
def split_rejects(spark, sf):
    doc = F.col("doc_id")
    posts = sample.posts(spark, sf).withColumns(
        {
            "md5": F.when(doc % 11 != 0, F.col("md5")),
            "published": F.when(doc % 13 == 0, F.concat("published", F.lit("Z"))).otherwise(F.col("published")),
        }
    )
    rows, rejects = extract.split_rejects(posts, extract.post_rejects())
    kept = rows.select("doc_id", F.lit("").alias("reject_reason"))
    return kept.unionByName(rejects.select("doc_id", "reject_reason"))


# -- joins -----------------------------------------------------------------------------
@query
def resolve_author(spark, sf):
    rows = star.resolve_author(sample.posts(spark, sf), sample.stored_users(spark, sf))
    return rows.select("title", F.col("author.slug").alias("author_slug"), "author_id")


def attached(spark, sf):
    info = articles.column_info(sample.column_responses(spark, sf))
    return star.attach_column(sample.posts(spark, sf), info)


@query
def resolve_creator(spark, sf):
    rows = star.resolve_creator(attached(spark, sf), sample.stored_users(spark, sf))
    return rows.select("title", F.col("creator.slug").alias("creator_slug"), "creator_id")


@query
def resolve_column(spark, sf):
    rows = star.resolve_column(sample.posts(spark, sf), sample.stored_columns(spark, sf))
    return rows.select("title", "column_slug", "belong_id")


@query
def load_fact(spark, sf):
    rows = star.load_fact(
        sample.posts(spark, sf), sample.stored_users(spark, sf), sample.stored_columns(spark, sf)
    )
    return rows.select("title", "md5", "author_id", "belong_id")


@query
def require_column(spark, sf):
    rows, rejects = star.require_column(sample.posts(spark, sf), sample.stored_columns(spark, sf))
    kept = rows.select("title", "belong_id", F.lit("").alias("reject_reason"))
    return kept.unionByName(
        rejects.select("title", F.lit(None).cast("long").alias("belong_id"), "reject_reason")
    )


@query
def known_members(spark, sf):
    known = sample.known_columns(spark, sf).withColumnRenamed("slug", "column_slug")
    rows = keyed.known_members(sample.posts(spark, sf), known, SEQ, "column_slug")
    return rows.select("title", "column_slug")


@query
def unknown_members(spark, sf):
    known = sample.known_columns(spark, sf).withColumnRenamed("slug", "column_slug")
    rows = keyed.unknown_members(sample.posts(spark, sf), known, SEQ, "column_slug")
    return rows.select("title", "column_slug")


@query
def prefer_creator_profile(spark, sf):
    return star.prefer_creator_profile(attached(spark, sf)).select("title", *flat("author"))


@query
def attach_column(spark, sf):
    return attached(spark, sf).select(
        "title", F.col("column.name").alias("column_name"), F.col("column.avatar").alias("column_avatar"),
        *flat("creator"),
    )


@query
def tag_bridge(spark, sf):
    posts = sample.posts(spark, sf).select("md5", "resp_seq", "pos", "doc_id")
    docs = sample.table(spark, sf, "documents").select("doc_id", "lang", "source")
    topics = posts.join(docs, "doc_id").select(
        "md5", "resp_seq", "pos",
        F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))).alias("topics"),
    )
    rows = runtime.materialize(extract.explode_tags(topics), "topics")
    made = runtime.materialize(star.new_tags(rows, empty(spark, schemas.TAG), AT), "tags")
    pairs = star.tag_bridge(
        rows, sample.stored_articles(spark, sf), made, empty(spark, schemas.ARTICLE_TAG)
    )
    return pairs.join(made.select(F.col("id").alias("tag_id"), "name"), "tag_id")


# -- aggregations ----------------------------------------------------------------------
@query
def count_articles(spark, sf):
    return summaries.count_articles(sample.stored_articles(spark, sf))


@query
def last_update_per_column(spark, sf):
    rows = summaries.last_update_per_column(
        sample.posts(spark, sf), sample.stored_columns(spark, sf)
    )
    return rows.select("slug", text_of("last_update_time").alias("last_update"))


@query
def max_id(spark, sf):
    return summaries.max_id(sample.stored_articles(spark, sf))


@query
def crawl_summary(spark, sf):
    at = F.lit("2024-05-06 07:08:09").cast("timestamp_ntz")
    return summaries.crawl_summary(sample.posts(spark, sf), at)


@query
def new_article_feed(spark, sf):
    new = keyed.insert_if_absent(
        sample.stored_articles(spark, sf), sample.posts(spark, sf).select(*SEQ, "md5", "token"), "md5", SEQ
    )
    feed = summaries.new_article_feed(new, BASE)
    return feed.withColumn("md5s", F.array_join("md5s", ","))


# -- order -----------------------------------------------------------------------------
@query
def first_write_wins(spark, sf):
    return keyed.first_write_wins(sample.posts(spark, sf), "md5", SEQ).select("md5", "title", "content")


@query
def until_first_seen(spark, sf):
    rows = paging.until_first_seen(sample.posts(spark, sf), sample.old_articles(spark, sf))
    return rows.select("title", "column_slug", "page")


@query
def assign_ids(spark, sf):
    users = sample.users(spark, sf)
    stored = sample.stored_users(spark, sf)
    new = users.select("slug").join(stored.select("slug"), "slug", "left_anti")
    return keyed.assign_ids(new, stored, "slug")


@query
def assign_ids_reserved(spark, sf):
    """Two loads that were planned from the same store."""
    stored = sample.stored_users(spark, sf)
    ledger = ids.IdLedger(spark, runtime.new_dir(spark, "ids"))
    ledger.reserve("users", "", summaries.max_id(stored).first()["max_id"])
    new = sample.users(spark, sf).select("slug", "id").join(stored.select("slug"), "slug", "left_anti")
    loads = []
    for name, odd in (("a", 0), ("b", 1)):
        rows = new.filter(F.col("id") % 2 == odd).select("slug")
        numbered = keyed.assign_ids(rows, stored, "slug", reserve=ledger.of("users", name))
        loads.append(numbered.withColumn("load", F.lit(name)))
    return loads[0].unionByName(loads[1])


@query
def take_pending(spark, sf):
    todo = keyed.pending(sample.users(spark, sf), "crawl_column")
    return paging.take_pending(todo, 5, ["id"]).select("id", "slug")


# -- sets ------------------------------------------------------------------------------
def _both_endpoints(spark, sf, kind):
    pages = (
        sample.follow_responses(spark, sf) if kind == "follow" else sample.user_column_responses(spark, sf)
    )
    first = F.contains(F.col("url"), F.lit("/followers" if kind == "follow" else "/column-contributions"))
    return pages.filter(first), pages.filter(~first)


@query
def union_members(spark, sf):
    followers, followees = _both_endpoints(spark, sf, "follow")
    rows = keyed.union_members(
        extract.explode_members(followers), extract.explode_members(followees), SEQ
    )
    return rows.select("slug", "name", "link", "hash")


@query
def union_columns(spark, sf):
    contributed, following = _both_endpoints(spark, sf, "column")
    rows = keyed.union_columns(
        extract.explode_contributions(contributed), extract.explode_following_columns(following), SEQ
    )
    return rows.select("slug", "link", "hash", "resp_seq")


@query
def discoverable_columns(spark, sf):
    found = extract.explode_recommendations(sample.recommendation_responses(spark, sf))
    return keyed.discoverable(found, sample.known_columns(spark, sf))


# -- keyed writes ----------------------------------------------------------------------
@query
def insert_if_absent(spark, sf):
    rows = keyed.insert_if_absent(
        sample.stored_articles(spark, sf), sample.posts(spark, sf), "md5", SEQ
    )
    return rows.select("md5", "title", "link")


@query
def insert_if_absent_keyed(spark, sf):
    """The same from a store by key hash, in two batches, the second after the first."""
    stored = sample.stored_articles(spark, sf)
    known = keyed_store.KeyedStore(spark, runtime.new_dir(spark, "keyed"), "md5", stored.schema, 1)
    known.write(stored, 0)
    posts = runtime.materialize(sample.posts(spark, sf).select(*SEQ, "md5", "title", "link", "doc_id"), "posts")
    half = posts.agg(F.expr("percentile_approx(resp_seq, 0.5)")).first()[0]
    found = []
    for no, part in enumerate((posts.filter(F.col("resp_seq") <= half), posts.filter(F.col("resp_seq") > half))):
        new = runtime.materialize(known.insert_if_absent(part, SEQ), "new")
        known.write(new.select("md5", F.lit(None).cast("long").alias("id")), no + 1)
        found.append(new.select("md5", "title", "link"))
    return found[0].unionByName(found[1])


@query
def flag_new(spark, sf):
    rows = keyed.flag_new(sample.stored_articles(spark, sf), sample.posts(spark, sf), "md5", SEQ)
    return rows.select("title", "md5", "is_new")


@query
def upsert_proxies(spark, sf):
    rows = keyed.upsert_proxies(
        sample.stored_proxies(spark, sf), proxy_rows(spark, sf), SEQ, "2024-05-06 07:08:09"
    )
    return rows.select("id", "host", "port", "protocol", "available", text_of("create_time").alias("created"))


@query
def mark_done(spark, sf):
    users = sample.users(spark, sf)
    done = users.filter(F.col("id") % 5 == 0)
    return keyed.mark_done(users, done, "crawl_follow").select("slug", "crawl_follow", "crawl_column")


@query
def dequeue(spark, sf):
    return keyed.dequeue(sample.column_queue(spark, sf), sample.known_columns(spark, sf))


@query
def pop_random(spark, sf):
    popped, rest = keyed.pop_random(sample.column_queue(spark, sf), 5, SEED)
    return popped.select("slug", F.lit(True).alias("popped")).unionByName(
        rest.select("slug", F.lit(False).alias("popped"))
    )


# -- page plans and frontiers ----------------------------------------------------------
@query
def offset_plan(spark, sf):
    info = extract.flatten_column_info(sample.column_responses(spark, sf))
    return paging.offset_plan(info).select("slug", "offset", "url")


@query
def cursor_pages(spark, sf):
    pages = sample.paged_responses(spark, sf, "members")
    starts = pages.filter(keys.offset_from_url(F.col("url")) == 0)
    twice = pages.unionByName(pages)  # every page was fetched twice
    return paging.cursor_pages(starts, extract.paging(twice))


@query
def seed_urls(spark, sf):
    users = sample.users(spark, sf)
    return paging.seed_urls(users, "follow").unionByName(paging.seed_urls(users, "column"))


@query
def random_plan(spark, sf):
    return paging.random_plan(sample.table(spark, sf, "pages"), "page_id", 10, SEED)


def _first_user(spark, sf):
    users = sample.users(spark, sf)
    return paging.take_pending(users, 1, ["id"]).select(F.col("slug").alias("user"))


@query
def expand_frontier(spark, sf):
    return frontier.expand_frontier(sample.follow_edges(spark, sf), _first_user(spark, sf))


# -- streaming -------------------------------------------------------------------------
def _land(spark, sf, start) -> None:
    """Let the event items land part by part and run the stream after each landing."""
    src, checkpoint = runtime.new_dir(spark, "landing"), runtime.new_dir(spark, "stream")
    for part in sample.event_arrivals(spark, sf):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(part.schema).parquet(src)
        start(stream, checkpoint).awaitTermination()


def _stored_items(spark, sf):
    items = sample.event_items(spark, sf)
    return keyed.first_write_wins(items.filter(F.col("slug").endswith("5")), "key", ["seq"])


@query
def append_batches(spark, sf):
    path = runtime.new_dir(spark, "appended")
    _land(spark, sf, lambda stream, cp: ingest.append_batches(stream, path, cp))
    schema = sample.event_items(spark, sf).schema
    return ingest.read_batches(spark, path, schema).select("seq", "key", "batch")


@query
def stream_insert_if_absent(spark, sf):
    path, stored = runtime.new_dir(spark, "inserted"), _stored_items(spark, sf)
    ingest.start_store(stored, path, "key")
    _land(
        spark, sf, lambda stream, cp: ingest.stream_insert_if_absent(stream, path, "key", ["seq"], cp)
    )
    return ingest.read_batches(spark, path, stored.schema).select("seq", "key", "batch")


@query
def stream_dedupe(spark, sf):
    path = runtime.new_dir(spark, "deduped")
    _land(
        spark, sf, lambda stream, cp: ingest.append_batches(ingest.stream_dedupe(stream, "key"), path, cp)
    )
    schema = sample.event_items(spark, sf).schema
    return ingest.read_batches(spark, path, schema).select("key", "batch")


@query
def append_batches_commits(spark, sf):
    """Rows of the largest commit: the commit size."""
    path = runtime.new_dir(spark, "appended")
    _land(spark, sf, lambda stream, cp: ingest.append_batches(stream, path, cp, COMMIT))
    rows = ingest.read_batches(spark, path, sample.event_items(spark, sf).schema, in_commits=True)
    made = rows.groupBy("batch", "commit").agg(F.count(F.lit(1)).alias("n"))
    return made.groupBy("batch").agg(F.sum("n").alias("n_rows"), F.max("n").alias("most"))


@query
def stream_dedupe_watermark(spark, sf):
    path = runtime.new_dir(spark, "deduped")

    def start(stream, cp):
        seen = ingest.stream_dedupe(stream, "key", "ts", "3650 days")
        return ingest.append_batches(seen, path, cp)

    _land(spark, sf, start)
    schema = sample.event_items(spark, sf).schema
    # Batches without rows move the watermark on, so numbers of batches say nothing here.
    return ingest.read_batches(spark, path, schema).select("key", "slug")


@query
def stream_last_update(spark, sf):
    path = runtime.new_dir(spark, "updates")
    _land(
        spark,
        sf,
        lambda stream, cp: ingest.write_updates(
            ingest.stream_last_update(stream, "slug", "ts"), path, cp
        ),
    )
    rows = spark.read.schema("slug string, last_update_time timestamp, batch int").parquet(path)
    return rows.groupBy("slug").agg(text_of(F.max("last_update_time")).alias("last_update"))


@query
def stream_batch_feed(spark, sf):
    path, feed = runtime.new_dir(spark, "inserted"), runtime.new_dir(spark, "feed")

    def start(stream, cp):
        keyed_items = stream.withColumns({"token": F.col("key"), "md5": keys.md5_key(F.col("key"))})
        return ingest.stream_batch_feed(keyed_items, path, "md5", ["seq"], cp, feed, BASE)

    stored = _stored_items(spark, sf)
    ingest.start_store(
        stored.withColumns({"token": F.col("key"), "md5": keys.md5_key(F.col("key"))}), path, "md5"
    )
    _land(spark, sf, start)
    rows = spark.read.schema("batch_no long, n_new int, links string, md5s array<string>, batch int")
    return rows.parquet(feed).withColumn("md5s", F.array_join("md5s", ","))


@query
def stream_commits(spark, sf):
    """Commits of exactly COMMIT items, the last one smaller."""
    schema = sample.event_items(spark, sf).schema
    made = commits.Commits(spark, runtime.new_dir(spark, "commits"), schema, COMMIT, ["seq"], "key")
    _land(spark, sf, made.run)
    made.close()
    rows = made.read().groupBy("commit").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    marks = made.marks().select("commit", "n_rows", F.array_join("items", ",").alias("items"))
    return rows.join(marks, "commit")


# -- end to end ------------------------------------------------------------------------
def _article_columns() -> list:
    return [
        "id", "title", "md5", "content", "summary", "cover", "link", "token", "keywords",
        "author_id", "belong_id", text_of("create_time").alias("created"),
    ]


def _ingest(spark, sf):
    return articles.ingest_articles(
        sample.post_responses(spark, sf), sample.column_responses(spark, sf), store(spark, sf), BASE, AT
    )


@query
def ingest_articles(spark, sf):
    return _ingest(spark, sf).articles.select(*_article_columns())


@query
def ingest_articles_keyed(spark, sf):
    """The same load on stores by key hash; its ids are reserved."""
    load = articles.ingest_articles(
        sample.post_responses(spark, sf), sample.column_responses(spark, sf), keyed_stores(spark, sf), BASE, AT
    )
    return load.articles.select(*_article_columns())


@query
def ingest_articles_keyed_again(spark, sf):
    """A second load of the same responses, after the first was stored, finds nothing new."""
    stores = keyed_stores(spark, sf)
    counts = []
    for no in (1, 2):
        stores.load = f"load {no}"
        load = articles.ingest_articles(
            sample.post_responses(spark, sf), sample.column_responses(spark, sf), stores, BASE, AT
        )
        stores.add(load, no)
        counts.append(load.articles.agg(F.lit(no).alias("load"), F.count(F.lit(1)).alias("n_new")))
    return counts[0].unionByName(counts[1])


@query
def ingest_articles_users(spark, sf):
    return _ingest(spark, sf).users.drop("create_time", "modify_time")


@query
def ingest_articles_columns(spark, sf):
    return _ingest(spark, sf).columns.drop("create_time", "modify_time", "last_update_time")


def _ingest_single(spark, sf):
    return articles.ingest_single_articles(
        sample.page_states(spark, sf), sample.column_responses(spark, sf), store(spark, sf),
        empty(spark, schemas.TAG), empty(spark, schemas.ARTICLE_TAG), BASE, AT,
    )


@query
def ingest_single_articles(spark, sf):
    return _ingest_single(spark, sf)[0].articles.select(*_article_columns())


@query
def ingest_single_articles_keyed(spark, sf):
    load, _, _ = articles.ingest_single_articles(
        sample.page_states(spark, sf), sample.column_responses(spark, sf), keyed_stores(spark, sf),
        empty(spark, schemas.TAG), empty(spark, schemas.ARTICLE_TAG), BASE, AT,
    )
    return load.articles.select(*_article_columns())


@query
def ingest_single_articles_tags(spark, sf):
    load, tags, pairs = _ingest_single(spark, sf)
    named = pairs.join(tags.select(F.col("id").alias("tag_id"), "name"), "tag_id")
    return named.select("zharticle_id", "tag_id", "name")


def _ingest_incremental(spark, sf):
    older = store(spark, sf, sample.old_articles)
    return articles.ingest_incremental(
        sample.column_queue(spark, sf), sample.column_responses(spark, sf),
        sample.post_responses(spark, sf), older, BASE, DRAWN, SEED, AT,
    )


@query
def ingest_incremental(spark, sf):
    return _ingest_incremental(spark, sf).articles.select(*_article_columns())


@query
def ingest_incremental_keyed(spark, sf):
    older = keyed_stores(spark, sf, sample.old_articles)
    load = articles.ingest_incremental(
        sample.column_queue(spark, sf), sample.column_responses(spark, sf),
        sample.post_responses(spark, sf), older, BASE, DRAWN, SEED, AT,
    )
    return load.articles.select(*_article_columns())


@query
def ingest_incremental_columns(spark, sf):
    rows = _ingest_incremental(spark, sf).columns
    return rows.select("slug", text_of("last_update_time").alias("last_update"))


def _follow_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Stored users and fetched pages as the written tables that a crawl reads several times."""
    users = runtime.materialize(sample.stored_users(spark, sf), "users")
    return users, runtime.materialize(sample.follow_responses(spark, sf), "responses")


@query
def crawl_follow_graph(spark, sf):
    _, users, _ = crawls.crawl_follow_graph(*_follow_inputs(spark, sf), AT)
    return users.select("id", "slug", "name", "crawl_follow", "crawl_column")


@query
def crawl_follow_graph_resumed(spark, sf):
    """Two runs equal one: by the first, the pages of half of the users were fetched."""
    stored, responses = _follow_inputs(spark, sf)
    member = F.xxhash64(F.regexp_extract("url", crawls.MEMBER, 1))
    early = responses.filter(member % 2 == 0)
    _, users, _ = crawls.crawl_follow_graph(stored, early, AT)
    users = runtime.materialize(users, "run")
    _, users, _ = crawls.resume_follow_crawl(users, responses, AT)
    return users.select("slug", "crawl_follow", "crawl_column")


@query
def unseen_responses(spark, sf):
    """The follow pages of users for whom a crawl has something to do."""
    finished = crawls.finished_users(sample.users(spark, sf), "crawl_follow")
    responses = runtime.materialize(sample.follow_responses(spark, sf), "responses")
    return crawls.unseen_responses(responses, finished).select("resp_seq")


@query
def discover_columns(spark, sf):
    users = runtime.materialize(sample.users(spark, sf), "users")
    responses = runtime.materialize(sample.user_column_responses(spark, sf), "responses")
    fresh, _, _ = crawls.discover_columns(
        users, responses, sample.known_user_columns(spark, sf), empty(spark, schemas.RANDOM_COLUMN), AT,
    )
    return fresh.select("id", "slug", "link", "hash")


@query
def discover_random_columns(spark, sf):
    fresh, _ = crawls.discover_random_columns(
        sample.recommendation_responses(spark, sf), sample.known_columns(spark, sf),
        empty(spark, schemas.RANDOM_COLUMN), AT,
    )
    return fresh.select("id", "slug", "link", "hash")


@query
def refresh_proxies(spark, sf):
    rows, _ = crawls.refresh_proxies(
        sample.proxy_pages(spark, sf), sample.proxy_checks(spark, sf), sample.stored_proxies(spark, sf), AT
    )
    return rows.select("id", "host", "port", "protocol", "available")


def _cut(responses: DataFrame, every: int) -> DataFrame:
    """Responses of which every so-manieth body breaks off before its end."""
    cut = F.col("resp_seq") % every == 0
    short = F.substring("body", F.lit(1), F.length("body") - 2)
    return responses.withColumn("body", F.when(cut, short).otherwise(F.col("body")))


@query
def ingest_articles_rejects(spark, sf):
    load = articles.ingest_articles(
        _cut(sample.post_responses(spark, sf), 5), sample.column_responses(spark, sf),
        store(spark, sf), BASE, AT,
    )
    return load.rejects.select("resp_seq", "reject_reason")


@query
def ingest_articles_queue(spark, sf):
    """What a load leaves in the queue: columns that did not answer."""
    _, left = articles.ingest_queue(
        sample.column_queue(spark, sf), sample.column_statuses(spark, sf),
        sample.post_responses(spark, sf), sample.column_responses(spark, sf), store(spark, sf), BASE, AT,
    )
    return left


def _stored(spark, sf):
    known = runtime.materialize(sample.known_columns(spark, sf), "known")
    return articles.store_load(_ingest(spark, sf), known, runtime.new_dir(spark, "star"), 0, BASE)


@query
def ingest_articles_feed(spark, sf):
    return _stored(spark, sf).feed.withColumn("md5s", F.array_join("md5s", ","))


@query
def ingest_articles_known_columns(spark, sf):
    return _stored(spark, sf).known


@query
def ingest_articles_stored(spark, sf):
    """The written articles, read back."""
    paths = _stored(spark, sf).paths
    rows = tables.read_store(spark, paths["articles"], schemas.ARTICLE)
    return rows.select("id", "md5", "author_id", "belong_id")


@query
def crawl_follow_graph_rejects(spark, sf):
    users, responses = _follow_inputs(spark, sf)
    *_, rejects = crawls.crawl_follow_graph(users, _cut(responses, 4), AT)
    return rejects.select("resp_seq", "reject_reason")


@query
def refresh_proxies_rejects(spark, sf):
    pages = sample.proxy_pages(spark, sf)
    # Every third row of a list loses its last cell.
    cut = F.regexp_replace("html", r"(?s)<td\b[^>]*>[^<]*</td>(\s*</tr>\s*</table>)", "$1")
    _, rejects = crawls.refresh_proxies(
        pages.withColumn("html", cut), sample.proxy_checks(spark, sf),
        sample.stored_proxies(spark, sf), AT,
    )
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def ingest_incremental_queue(spark, sf):
    return _ingest_incremental(spark, sf).queue.select("slug")


@query
def store_round_trip(spark, sf):
    """Two states of the user table; readers get the newer one, each row once."""
    path = runtime.new_dir(spark, "users")
    tables.write_snapshot(sample.users(spark, sf), path, 0)
    users = tables.read_snapshot(spark, path, schemas.USER)
    done = keyed.pending(users, "crawl_follow").select("slug")
    tables.write_snapshot(keyed.mark_done(users, done, "crawl_follow"), path, 1)
    return tables.read_snapshot(spark, path, schemas.USER).select("id", "slug", "crawl_follow")


@query
def new_articles_per_column(spark, sf):
    """Which articles of this crawl are new, per column?"""
    posts = extract.explode_posts(sample.post_responses(spark, sf)).select(*SEQ, "column_slug", "md5")
    flagged = keyed.flag_new(sample.stored_articles(spark, sf), posts, "md5", SEQ)
    return flagged.groupBy("column_slug").agg(
        F.count(F.when(F.col("is_new"), 1)).alias("n_new"),
        F.count(F.when(~F.col("is_new"), 1)).alias("n_known"),
    )

"""Article loads, end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.functions import keys
from crawlmart.operators import extract, keyed, paging, star, summaries
from crawlmart.operators.extract import SEQ
from crawlmart.sources import tables
from crawlmart.sources.ids import IdLedger
from crawlmart.sources.keyed_store import KeyedStore


@dataclass
class Store:
    """What is stored already. Articles need (md5, id) only. With ``ids``, new ids are
    reserved there; else they follow the greatest one that is stored."""

    users: DataFrame
    columns: DataFrame
    articles: DataFrame
    ids: IdLedger | None = None
    load: str = ""  # name of the load that reserves

    def reserve(self, table: str):
        return None if self.ids is None else self.ids.of(table, self.load)

    def near(self, posts: DataFrame) -> Store:
        """The store as far as these posts need it."""
        return self

    def articles_near(self, posts: DataFrame) -> DataFrame:
        """The articles that these posts (md5) may meet."""
        return self.articles


@dataclass
class KeyedStores(Store):
    """A store whose users (by slug) and articles (by md5) lie in folders by a hash of their
    key, so that a load reads what its keys may meet and no more. New ids are reserved, as the
    greatest stored one would take a look at all rows. Columns are few."""

    users: KeyedStore
    articles: KeyedStore

    def articles_near(self, posts: DataFrame) -> DataFrame:
        return runtime.materialize(self.articles.near(posts.select("md5")), "near_articles")

    def near(self, posts: DataFrame) -> Store:
        people = star.user_candidates(posts).select("slug")
        return Store(
            runtime.materialize(self.users.near(people), "near_users"),
            self.columns,
            self.articles_near(posts),
            self.ids,
            self.load,
        )

    def add(self, load: Load, batch: int) -> None:
        """Store what a load has added."""
        self.columns = self.columns.unionByName(load.columns)
        self.users.write(load.users, batch)
        self.articles.write(load.articles.select("md5", "id"), batch)


@dataclass
class Load:
    """What a load adds; ``columns`` is the full snapshot where a load updates columns."""

    users: DataFrame
    columns: DataFrame
    articles: DataFrame
    rejects: DataFrame
    queue: DataFrame | None = None  # what is left of it, where a load draws from one


def _rejects(df: DataFrame) -> DataFrame:
    return df.select(*SEQ, "column_slug", "md5", "reject_reason")


def column_info(responses: DataFrame) -> DataFrame:
    """One row per column, the first response wins. Written, so that its size is known when
    posts are joined to it."""
    info = keyed.first_write_wins(extract.flatten_column_info(responses), "slug", ["resp_seq"])
    return runtime.materialize(info, "info")


def store_posts(posts: DataFrame, store: Store, base: str, at: Column | str | None) -> Load:
    """Insert users, columns and articles that are absent. ``posts`` is a written table:
    it is read once per target. A post rejected as an article still yields its users and
    its column, as their rows do not depend on it."""
    store = store.near(posts)
    users = star.new_users(posts, store.users, at, store.reserve("users"))
    users = runtime.materialize(users, "users")
    all_users = store.users.unionByName(users)
    columns = star.new_columns(posts, store.columns, all_users, at, store.reserve("columns"))
    columns = runtime.materialize(columns, "columns")
    valid, rejects = extract.split_rejects(posts, extract.post_rejects())
    articles = star.article_rows(
        valid, store.articles, all_users, store.columns.unionByName(columns), base,
        store.reserve("articles"),
    )
    # Written: what is new must not change when the store does.
    return Load(users, columns, runtime.materialize(articles, "articles"), _rejects(rejects))


def _broken_columns(responses: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return extract.column_rejects(responses).select(
        "resp_seq", F.lit(None).cast("int").alias("pos"), none.alias("column_slug"),
        none.alias("md5"), "reject_reason",
    )


def _split_broken(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts, rejects) of a written table of both."""
    rows = posts.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return rows, _rejects(posts.filter(F.col("reject_reason").isNotNull()))


def _busy_columns(post_responses: DataFrame) -> DataFrame:
    """Columns with very many posts, from the addresses of their pages."""
    slug = keys.column_from_api_url(F.col("url")).alias("column_slug")
    return runtime.hot_keys(
        post_responses.select(slug), "column_slug", runtime.ROWS_PER_TASK // paging.PAGE_STEP
    )


def ingest_articles(
    post_responses: DataFrame,
    column_responses: DataFrame,
    store: Store,
    base: str,
    at: Column | str | None = None,
) -> Load:
    """Full load of the fetched pages of columns. Every post is new, known or a reject; a body
    that does not parse is one reject."""
    posts = star.attach_column(
        extract.explode_posts(post_responses, broken=True),
        column_info(column_responses),
        _busy_columns(post_responses),
    )
    posts = runtime.materialize(star.prefer_creator_profile(posts), "posts")
    posts, broken = _split_broken(posts)
    load = store_posts(posts, store, base, at)
    load.rejects = load.rejects.unionByName(broken).unionByName(_broken_columns(column_responses))
    return load


@dataclass
class Stored:
    """What storing a load gives: the path of each table, the set of known columns with the
    new ones, and the feed of the new articles."""

    paths: dict[str, str]
    known: DataFrame
    feed: DataFrame


def store_load(load: Load, known: DataFrame, root: str, batch: int, base: str) -> Stored:
    """Write a load's dimensions, then its facts, and publish what is new."""
    dims = {"users": load.users, "columns": load.columns}
    paths = tables.write_star(dims, {"articles": load.articles.drop(*SEQ)}, root, batch)
    feed = summaries.new_article_feed(load.articles, base)
    return Stored(paths, tables.add_to_set(known, load.columns), feed)


def fetchable(queue: DataFrame, responses: DataFrame, done: DataFrame) -> DataFrame:
    """What is left of a queue after a run: without columns that answered 404 and without
    those that were loaded. ``responses`` has slug and status."""
    return keyed.dequeue(keyed.dead_links(queue, responses, "slug"), done)


def ingest_queue(
    queue: DataFrame,
    statuses: DataFrame,
    post_responses: DataFrame,
    column_responses: DataFrame,
    store: Store,
    base: str,
    at: Column | str | None = None,
) -> tuple[Load, DataFrame]:
    """Full load of a queue of columns, and what is left of the queue: columns that answered
    neither with a body nor with 404 are asked again in the next run. ``statuses`` has slug and
    status of the columns' responses; a slug may have several, and then one 404 removes it.
    Posts of columns that did not answer are loaded without a column."""
    answered = statuses.filter(F.col("status") == 200).select("slug").distinct()
    slug = keys.column_from_api_url(F.col("url"))
    bodies = column_responses.withColumn("slug", slug).join(answered, "slug", "left_semi").drop("slug")
    load = ingest_articles(post_responses, bodies, store, base, at)
    done = store.columns.select("slug").unionByName(load.columns.select("slug")).distinct()
    return load, fetchable(queue, statuses, done)


def ingest_single_articles(
    pages: DataFrame,
    column_responses: DataFrame,
    store: Store,
    tags: DataFrame,
    bridge: DataFrame,
    base: str,
    at: Column | str | None = None,
) -> tuple[Load, DataFrame, DataFrame]:
    """Load of single article pages; also gives new tags and new bridge rows."""
    states = extract.embedded_json(
        pages, "html", "preloadedState", schemas.POST_STATE, extract.repair_state
    )
    # Pages without a usable state are marked here and split off after the write: a filter
    # on the parsed state would have every page parsed twice.
    states = extract.with_reject_reason(states, extract.state_rejects())
    posts = extract.flatten_post_state(states, keep=("reject_reason",))
    info = column_info(column_responses)
    if not runtime.fits_broadcast(info):  # the lookup reads the posts more than once
        posts = runtime.materialize(posts, "states")
    posts = star.attach_column(posts, info)
    marked = runtime.materialize(posts, "posts")
    no_state = marked.filter(F.col("reject_reason").isNotNull())
    posts = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    load = store_posts(posts, store, base, at)
    load.rejects = load.rejects.unionByName(_rejects(no_state)).unionByName(
        _broken_columns(column_responses)
    )
    # Tags of the stored copy of an article only.
    stored = posts.join(load.articles.select(*SEQ), SEQ, "left_semi")
    topics = runtime.materialize(extract.explode_tags(stored), "topics")
    made = runtime.materialize(star.new_tags(topics, tags, at), "tags")
    pairs = star.tag_bridge(topics, load.articles, tags.unionByName(made), bridge)
    return load, made, pairs


def ingest_incremental(
    queue: DataFrame,
    column_responses: DataFrame,
    post_responses: DataFrame,
    store: Store,
    base: str,
    n: int,
    seed: int,
    at: Column | str | None = None,
) -> Load:
    """Load of ``n`` columns drawn from the queue, each up to the page with the first known
    article. Unknown columns are rejected; last_update_time is raised; ``queue`` is what is
    left of it. Keys alone decide which pages count; only those are parsed in full."""
    popped, _ = keyed.pop_random(queue, n, seed)
    popped = runtime.materialize(popped, "popped")
    left = queue.join(popped.select("slug"), "slug", "left_anti")
    info = column_info(column_responses).join(popped, "slug", "left_semi")
    planned = paging.offset_plan(info).select("url")
    fetched = post_responses.join(planned, "url", "left_semi")
    found = runtime.materialize(extract.post_keys(fetched), "keys")
    found, broken = _split_broken(found)
    found = found.withColumn("page", F.floor(F.col("offset") / paging.PAGE_STEP))
    # Posts have no author yet: here only the articles are looked up.
    known_articles = store.articles_near(found)
    kept = runtime.materialize(paging.until_first_seen(found, known_articles), "kept")
    known, unknown = star.require_column(kept, store.columns)
    pages = runtime.materialize(known.select("resp_seq").distinct(), "pages")
    rows = extract.explode_posts(post_responses.join(pages, "resp_seq", "left_semi"))
    rows = star.prefer_creator_profile(star.attach_column(rows, info, _busy_columns(fetched)))
    rows = runtime.materialize(rows, "posts")
    valid, rejects = extract.split_rejects(rows, extract.post_rejects())
    # This path stores authors only, so no creators are offered.
    authors = rows.withColumn("creator", F.lit(None).cast(schemas.USER_ITEM))
    store = store.near(authors)
    users = star.new_users(authors, store.users, at, store.reserve("users"))
    users = runtime.materialize(users, "users")
    articles = star.article_rows(
        valid, store.articles, store.users.unionByName(users), store.columns, base,
        store.reserve("articles"),
    )
    articles = runtime.materialize(articles, "articles")
    columns = summaries.last_update_per_column(valid, store.columns)
    every = _rejects(rejects).unionByName(_rejects(unknown)).unionByName(broken)
    return Load(users, columns, articles, every.unionByName(_broken_columns(column_responses)), left)

"""Lookups that tie posts to users, columns and tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import schemas
from crawlmart.functions import html, keys
from crawlmart.operators.extract import SEQ
from crawlmart.operators.keyed import assign_ids, insert_if_absent
from crawlmart.runtime import lookup

ROLE = "role"
#: Gets a number of ids and gives the one before the first of them.
Reserve = Callable[[int], int] | None
USER_FIELDS = schemas.USER_ITEM.fieldNames()


def attach_column(posts: DataFrame, info: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Every post with its ``column`` and ``creator``; without a column or a creator the
    author counts as the creator. ``hot`` names the busy columns, if they are known without
    reading the posts."""
    fields = [F.col(name) for name in schemas.COLUMN_ITEM.fieldNames()]
    dim = info.select(
        F.col("slug").alias("column_slug"), F.struct(*fields).alias("column"), "creator"
    )
    joined = lookup(posts, dim, "column_slug", SEQ, hot=hot)
    return joined.withColumn("creator", F.coalesce("creator", "author"))


def prefer_creator_profile(posts: DataFrame) -> DataFrame:
    """Where author and creator have the same hash, the creator's profile is the author."""
    same = F.col("author.hash") == F.col("creator.hash")
    return posts.withColumn("author", F.when(same, F.col("creator")).otherwise(F.col("author")))


def user_candidates(posts: DataFrame) -> DataFrame:
    """Author and creator rows in arrival order, the author first within a post."""
    author = posts.select(*SEQ, F.lit(0).alias(ROLE), "author.*")
    creator = posts.select(*SEQ, F.lit(1).alias(ROLE), "creator.*")
    return author.unionByName(creator).filter(F.col("slug").isNotNull())


def new_users(
    posts: DataFrame, users: DataFrame, at: Column | str | None = None, reserve: Reserve = None
) -> DataFrame:
    """Users to create, in the layout of the user table."""
    rows = insert_if_absent(users, user_candidates(posts), "slug", [*SEQ, ROLE])
    rows = assign_ids(rows.select(*USER_FIELDS), users, "slug", reserve=reserve)
    rows = keys.stamp(rows, at).withColumns(
        {"crawl_column": F.lit(False), "crawl_follow": F.lit(False)}
    )
    return rows.select(*schemas.USER.fieldNames())


def resolve_user(posts: DataFrame, users: DataFrame, role: str) -> DataFrame:
    """Add ``<role>_id`` by slug; null where the user is unknown."""
    dim = users.select(F.col("slug").alias("_slug"), F.col("id").alias(f"{role}_id"))
    return lookup(posts.withColumn("_slug", F.col(f"{role}.slug")), dim, "_slug", SEQ).drop("_slug")


def resolve_author(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``author_id``; the unmatched are the users to create."""
    return resolve_user(posts, users, "author")


def resolve_creator(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``creator_id``; a creator who is the author resolves to the same user."""
    return resolve_user(posts, users, "creator")


def new_columns(
    posts: DataFrame,
    columns: DataFrame,
    users: DataFrame,
    at: Column | str | None = None,
    reserve: Reserve = None,
) -> DataFrame:
    """Columns to create, in the layout of the column table, with the creator's id."""
    rows = posts.filter(F.col("column").isNotNull()).select(
        *SEQ, "column.*", F.col("creator.slug").alias("_creator")
    )
    rows = insert_if_absent(columns, rows, "hash", SEQ).drop(*SEQ)
    creators = users.select(F.col("slug").alias("_creator"), F.col("id").alias("creator_id"))
    rows = lookup(rows, creators, "_creator", ["hash"])
    rows = assign_ids(rows, columns, "slug", reserve=reserve)
    rows = keys.stamp(rows, at).withColumn("last_update_time", F.lit(None).cast("timestamp_ntz"))
    return rows.select(*schemas.COLUMN.fieldNames())


def resolve_column(posts: DataFrame, columns: DataFrame) -> DataFrame:
    """Add ``belong_id`` by column hash; null where the column is unknown."""
    dim = columns.select(F.col("hash").alias("_hash"), F.col("id").alias("belong_id"))
    keyed = posts.withColumn("_hash", keys.md5_key(F.col("column_slug")))
    return lookup(keyed, dim, "_hash", SEQ).drop("_hash")


def load_fact(posts: DataFrame, users: DataFrame, columns: DataFrame) -> DataFrame:
    """Posts with author_id and belong_id."""
    return resolve_column(resolve_author(posts, users), columns)


def article_rows(
    posts: DataFrame,
    articles: DataFrame,
    users: DataFrame,
    columns: DataFrame,
    base: str,
    reserve: Reserve = None,
) -> DataFrame:
    """Articles to insert, in the layout of the article table plus the arrival order.

    Keys, ids and references are settled on narrow rows; the wide rows move once, when the
    new ones among them are picked by their arrival order, which is unique.
    """
    narrow = posts.select(*SEQ, "md5", "column_slug", F.struct("author.slug").alias("author"))
    new = insert_if_absent(articles, narrow, "md5", SEQ)
    new = assign_ids(new, articles, "md5", reserve=reserve)
    fact = load_fact(new, users, columns).select(*SEQ, "id", "author_id", "belong_id")
    time = keys.parse_published(F.col("published"))
    rows = posts.join(fact, SEQ).withColumns(
        {
            "cover": html.cover_or_first_image(F.col("cover"), F.col("content")),
            "content": html.rewrite_article(F.col("content"), base),
            "create_time": time,
            "modify_time": time,
            "keywords": F.lit(""),
        }
    )
    return rows.select(*schemas.ARTICLE.fieldNames(), *SEQ)


def require_column(posts: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts of known columns with belong_id, posts of unknown columns), from one join."""
    dim = columns.select(F.col("slug").alias("column_slug"), F.col("id").alias("belong_id"))
    rows = lookup(posts, dim, "column_slug", SEQ)
    missing = rows.filter(F.col("belong_id").isNull()).drop("belong_id")
    known = rows.filter(F.col("belong_id").isNotNull())
    return known, missing.withColumn("reject_reason", F.lit("unknown_column"))


def new_tags(tag_rows: DataFrame, tags: DataFrame, at: Column | str | None = None) -> DataFrame:
    """Tags to create, one per name, in the layout of the tag table."""
    names = tag_rows.filter(F.col("name").isNotNull()).select("name").distinct()
    names = names.join(tags.select("name"), "name", "left_anti")
    return keys.stamp(assign_ids(names, tags, "name"), at).select(*schemas.TAG.fieldNames())


def tag_bridge(tag_rows: DataFrame, articles: DataFrame, tags: DataFrame, bridge: DataFrame) -> DataFrame:
    """New bridge rows: one per article and tag that is not in the bridge yet."""
    pairs = tag_rows.select("md5", "name").distinct()
    article_ids = articles.select("md5", F.col("id").alias("zharticle_id"))
    pairs = lookup(pairs, article_ids, "md5", ["name"], "inner")
    tag_ids = tags.select("name", F.col("id").alias("tag_id"))
    pairs = lookup(pairs, tag_ids, "name", ["md5"], "inner").select("zharticle_id", "tag_id")
    pairs = pairs.join(bridge.select("zharticle_id", "tag_id"), ["zharticle_id", "tag_id"], "left_anti")
    keyed = pairs.withColumn("_pair", F.concat_ws(":", "zharticle_id", "tag_id"))
    return assign_ids(keyed, bridge, "_pair").select(*schemas.ARTICLE_TAG.fieldNames())

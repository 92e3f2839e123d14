"""Crawls over users, columns and proxies, end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime, schemas
from crawlmart.functions import keys
from crawlmart.operators import extract, keyed, paging
from crawlmart.operators.extract import SEQ
from crawlmart.operators.frontier import expand_frontier
from crawlmart.operators.seen import SeenKeys, seen_keys

MEMBER = "/members/([^/?]+)/"


def _owned(users: DataFrame, responses: DataFrame, kind: str) -> DataFrame:
    """(resp_seq, url, root, owner) of the responses on the chains that start at the users'
    first pages. Of a page that was fetched several times the first one counts. Only addresses
    and numbers move; bodies are read where they lie, before and after."""
    once = keyed.first_write_wins(responses.select("url", "resp_seq"), "url", ["resp_seq"])
    starts = paging.seed_urls(users, kind).select("url", "slug")
    reached = paging.cursor_pages(starts, extract.paging(responses))
    # One user may own a large share of the pages, so the lookup by chain is a balanced one;
    # the joins by address and number are between unique keys.
    roots = starts.select(F.col("url").alias("root"), F.col("slug").alias("owner"))
    owned = runtime.lookup(reached, roots, "root", ["hop"], "inner").select("url", "root", "owner")
    return runtime.materialize(owned.join(once, "url"), "owned")


def _ends(responses: DataFrame) -> DataFrame:
    return runtime.materialize(extract.page_ends(responses, "resp_seq"), "ends")


def complete_owners(owned: DataFrame, ends: DataFrame, kind: str) -> DataFrame:
    """Users all of whose chains were fetched up to their last page; ``ends`` has the numbers
    of the responses that are one."""
    chains = owned.select("resp_seq", "root", "owner").join(ends, "resp_seq")
    done = chains.select("owner", "root").distinct().groupBy("owner").agg(F.count(F.lit(1)).alias("n"))
    return done.filter(F.col("n") == len(paging.SEEDS[kind])).select(F.col("owner").alias("slug"))


def _of(owned: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows that come from owned responses."""
    return rows.join(owned.select("resp_seq"), "resp_seq", "left_semi")


def _rejects(df: DataFrame, key: str = "slug") -> DataFrame:
    """(resp_seq, pos, reject_reason) of rows without a key; pos is null for a whole body."""
    bad = df.filter(F.coalesce(F.col(key), F.lit("")) == "")
    return bad.select("resp_seq", "pos", F.lit("no_key").alias("reject_reason"))


def _broken(responses: DataFrame, schema) -> DataFrame:
    bad = extract.broken_bodies(responses, schema)
    return bad.select("resp_seq", F.lit(None).cast("int").alias("pos"), "reject_reason")


def _owner(df: DataFrame) -> DataFrame:
    return df.select(F.regexp_extract("url", MEMBER, 1).alias("slug")).distinct()


def crawl_follow_graph(
    users: DataFrame, responses: DataFrame, at: Column | str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new users, full user snapshot, rejects) of a follow crawl that runs until nobody is
    pending.

    Pending users and everybody first met through them are crawled; known users with the
    flag set or unknown are met but not crawled. Done are those crawled users whose chains
    were fetched to their ends; the others stay pending.
    """
    waiting = runtime.materialize(keyed.pending(users, "crawl_follow").select("slug"), "pending")
    idle = users.select("slug").join(waiting, "slug", "left_anti")
    owners = _owner(responses).join(idle, "slug", "left_anti")
    owned = _owned(owners, responses, "follow")
    members = runtime.materialize(extract.explode_members(responses), "members")
    named = members.select(*SEQ, "slug")
    edges = named.join(owned.select("resp_seq", "owner"), "resp_seq").select(
        F.col("owner").alias("src"), F.col("slug").alias("dst")
    )
    reached = expand_frontier(edges, waiting.select(F.col("slug").alias("user")))
    crawled = reached.select(F.col("user").alias("slug")).join(idle, "slug", "left_anti")
    crawled = runtime.materialize(crawled, "crawled")
    owners = crawled.withColumnRenamed("slug", "owner")
    met = runtime.lookup(
        owned.select("resp_seq", "owner"), owners, "owner", ["resp_seq"], "left_semi"
    )
    met = keyed.non_empty_key(_of(met, named), "slug")
    # Who is new is settled on keys; only the new ones' profiles move.
    new = keyed.insert_if_absent(users, met, "slug", SEQ).select(*SEQ)
    fresh = keyed.assign_ids(members.join(new, SEQ, "left_semi").drop(*SEQ), users, "slug")
    fresh = keys.stamp(fresh, at).withColumns(
        {"crawl_column": F.lit(False), "crawl_follow": F.lit(False)}
    )
    fresh = runtime.materialize(fresh.select(*schemas.USER.fieldNames()), "users")
    done = crawled.join(complete_owners(owned, _ends(responses), "follow"), "slug", "left_semi")
    rejects = _of(owned, _broken(responses, schemas.MEMBERS).unionByName(_rejects(members)))
    rejects = rejects.select("resp_seq", "pos", "reject_reason")
    return fresh, keyed.mark_done(users.unionByName(fresh), done, "crawl_follow"), rejects


def finished_users(users: DataFrame, flag: str) -> SeenKeys:
    """The users that a crawl by ``flag`` has nothing to do for, behind a Bloom filter."""
    waiting = keyed.pending(users, flag).select("slug")
    return seen_keys(users.select("slug").join(waiting, "slug", "left_anti"), "slug")


def unseen_responses(responses: DataFrame, finished: SeenKeys) -> DataFrame:
    """Responses whose address is not one of a finished user's."""
    rows = responses.withColumn(finished.key, F.regexp_extract("url", MEMBER, 1))
    return finished.unseen(rows, ["resp_seq"]).drop(finished.key)


def resume_follow_crawl(
    users: DataFrame, responses: DataFrame, at: Column | str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``crawl_follow_graph`` after earlier runs, whose user snapshot ``users`` is:
    ``responses`` may hold all that was ever fetched, and the bodies of users that earlier
    runs have finished are not parsed. A chain stays at its own user's addresses. The rest is
    written, as a crawl reads it several times and it is found by a filter and a join."""
    rest = unseen_responses(responses, finished_users(users, "crawl_follow"))
    rest = runtime.materialize(rest, "rest")
    return crawl_follow_graph(users, rest, at)


def resume_discovery(
    users: DataFrame,
    responses: DataFrame,
    known: DataFrame,
    queue: DataFrame,
    at: Column | str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``discover_columns`` after earlier runs, in the same way."""
    rest = unseen_responses(responses, finished_users(users, "crawl_column"))
    rest = runtime.materialize(rest, "rest")
    return discover_columns(users, rest, known, queue, at)


def _new_random_columns(
    found: DataFrame, known: DataFrame, queue: DataFrame, at: Column | str | None
) -> DataFrame:
    """Columns to queue: with a slug, not known, not queued, first write wins."""
    rows = keyed.insert_if_absent(queue, keyed.non_empty_key(found, "slug"), "slug", SEQ)
    rows = rows.join(known.select("slug"), "slug", "left_anti")
    rows = keys.stamp(keyed.assign_ids(rows, queue, "slug"), at)
    return rows.select(*schemas.RANDOM_COLUMN.fieldNames())


def discover_columns(
    users: DataFrame,
    responses: DataFrame,
    known: DataFrame,
    queue: DataFrame,
    at: Column | str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(columns to queue, user snapshot, rejects): columns that pending users contribute to or
    follow. Done are users whose chains were fetched to their ends."""
    waiting = runtime.materialize(keyed.pending(users, "crawl_column").select("slug"), "pending")
    owned = _owned(waiting, responses, "column")
    contributed = F.contains(F.col("url"), F.lit("/column-contributions"))
    found = extract.explode_contributions(responses.filter(contributed)).unionByName(
        extract.explode_following_columns(responses.filter(~contributed))
    )
    found = _of(owned, runtime.materialize(found, "found"))
    fresh = _new_random_columns(found, known, queue, at)
    broken = _broken(responses.filter(contributed), schemas.CONTRIBUTIONS).unionByName(
        _broken(responses.filter(~contributed), schemas.FOLLOWING)
    )
    rejects = _of(owned, broken).select("resp_seq", "pos", "reject_reason").unionByName(_rejects(found))
    done = complete_owners(owned, _ends(responses), "column")
    return fresh, keyed.mark_done(users, done, "crawl_column"), rejects


def discover_random_columns(
    responses: DataFrame,
    known: DataFrame,
    queue: DataFrame,
    at: Column | str | None = None,
    plan: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(columns to queue, rejects) from the lists of recommendations; with a ``plan`` of
    drawn requests, from the responses to those alone."""
    if plan is not None:
        responses = responses.join(plan.select("url").distinct(), "url", "left_semi")
    found = runtime.materialize(extract.explode_recommendations(responses), "found")
    rejects = _broken(responses, schemas.RECOMMENDATIONS).unionByName(_rejects(found))
    return _new_random_columns(found, known, queue, at), rejects


def refresh_proxies(
    pages: DataFrame, checks: DataFrame, existing: DataFrame, at: Column | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(proxy snapshot, rejects) after reading the lists and keeping what passed its check."""
    pages = pages.withColumnRenamed("page_id", "resp_seq")
    rows = extract.html_table_rows(pages, "html", extract.layout_columns("layout"))
    rows = runtime.materialize(rows, "listed")
    missing = F.col("host").isNull() | F.col("port").isNull() | F.col("protocol").isNull()
    whole, rejects = extract.split_rejects(rows, {"missing_cell": missing})
    good = keyed.available(whole, checks, ["host", "port"], SEQ)
    snapshot = keyed.upsert_proxies(existing, runtime.materialize(good, "proxies"), SEQ, at)
    return snapshot, rejects.select("resp_seq", "pos", "reject_reason")

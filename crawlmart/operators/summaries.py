"""Counts, maxima and feeds of new rows (A1-A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart.functions.html import ARTICLE_PATH
from crawlmart.functions.keys import parse_published
from crawlmart.operators.extract import SEQ

# Fixed value: the summary message.
SUMMARY = "[%s]抓取专栏%s文章成功，抓取数目: %d"


def count_articles(df: DataFrame) -> DataFrame:
    """Number of articles in the store."""
    return df.agg(F.count("id").alias("n_articles"))


def max_id(df: DataFrame) -> DataFrame:
    """Greatest id, 0 for an empty table."""
    return df.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("max_id"))


def last_update_per_column(posts: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns with last_update_time raised to the latest post; an unset one is set."""
    latest = posts.groupBy(F.col("column_slug").alias("slug")).agg(
        F.max(parse_published(F.col("published"))).alias("_latest")
    )
    return (
        columns.join(latest, "slug", "left")
        .withColumn("last_update_time", F.greatest("last_update_time", "_latest"))
        .drop("_latest")
    )


def crawl_summary(items: DataFrame, at: Column) -> DataFrame:
    """Items per column with the message of a finished run."""
    counts = items.groupBy("column_slug").agg(F.count(F.lit(1)).alias("n_items"))
    text = F.format_string(
        SUMMARY, F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.col("column_slug"), F.col("n_items")
    )
    return counts.withColumn("message", text)


def new_article_feed(new: DataFrame, base: str, n: int = 10, seq: list[str] = SEQ) -> DataFrame:
    """Links and keys of new articles, ``n`` per batch in arrival order; the last batch may
    be smaller. Every group has ``n`` rows at most."""
    from crawlmart.operators.keyed import number_rows

    numbered = number_rows(new.select(*seq, "md5", "token"), seq)
    link = F.concat(F.lit(base + ARTICLE_PATH), "token")
    batch = F.floor((F.col("rn") - 1) / n).cast("long").alias("batch_no")
    rows = F.sort_array(F.collect_list(F.struct("rn", link.alias("link"), "md5")))
    grouped = numbered.groupBy(batch).agg(rows.alias("rows"))
    return grouped.select(
        "batch_no",
        F.size("rows").alias("n_new"),
        F.array_join("rows.link", "\n").alias("links"),
        F.col("rows.md5").alias("md5s"),
    )

"""Keyed sets and writes.

All are pure functions from frames to frames; the caller decides what is written where.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.functions import keys
from crawlmart.operators.summaries import max_id


# -- order -----------------------------------------------------------------------------
def first_write_wins(df: DataFrame, key: str, seq: list[str]) -> DataFrame:
    """The first row of every key in ``seq`` order, which must be total.

    The rank is cut to 1 before the shuffle as well as after it, so each input partition
    sends one row per key at most and a hot key costs nothing extra.
    """
    order = Window.partitionBy(key).orderBy(*seq)
    return (
        df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == 1).drop("_rn")
    )


def assign_ids(
    new: DataFrame,
    existing: DataFrame,
    key: str,
    digits: int = 4,
    reserve: Callable[[int], int] | None = None,
) -> DataFrame:
    """Dense ids ``max+1, max+2, …`` for rows unique on ``key``, in order of the key's md5.
    With ``reserve``, which gets the number of rows and gives the id before the first, ids
    come from there (see ``sources.ids``) and ``existing`` is not read.

    Rows are numbered inside 16**digits buckets of the md5 and shifted by the sizes of the
    buckets before. The buckets are even whatever the keys look like, depend on data only
    (a retried task numbers alike), and the table of offsets has 16**digits rows at most.
    The rows are written first, as they are read for the sizes and for the numbers.
    """
    path = runtime.new_dir(new.sparkSession, "unnumbered")
    n = runtime.write_counted(new, path)
    rows = new.sparkSession.read.schema(new.schema).parquet(path)
    hashed = rows.withColumn("_md5", F.md5(key)).withColumn(
        "_bucket", F.substring("_md5", 1, digits)
    )
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    numbered = hashed.join(F.broadcast(offsets), "_bucket")
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_md5", key))
    if reserve is None:
        start = max_id(existing).select("max_id").scalar()
    else:
        start = F.lit(reserve(n)).cast("long")
    return numbered.withColumn("id", start + F.col("_before") + inside).drop(
        "_md5", "_bucket", "_before"
    )


def number_rows(df: DataFrame, seq: list[str], name: str = "rn") -> DataFrame:
    """Dense row numbers 1, 2, … in ``seq`` order (total) without a one-partition sort.

    Rows are range partitioned and written with their partition number, so the numbers
    cannot move when a task is retried; each partition is then numbered on its own.
    """
    parted = df.repartitionByRange(*seq).withColumn("_part", F.spark_partition_id())
    stored = runtime.materialize(parted, "numbered")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*seq))
    return (
        stored.join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumn(name, F.col("_before") + inside)
        .drop("_part", "_before")
    )


# -- filters ---------------------------------------------------------------------------
def dead_links(queue: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """The queue without entries whose response was a 404."""
    gone = responses.filter(F.col("status") == 404).select(key).distinct()
    return queue.join(gone, key, "left_anti")


def pending(users: DataFrame, flag: str) -> DataFrame:
    """Users whose flag is false; an unknown flag does not count as false."""
    return users.filter(~F.col(flag))


def non_empty_key(df: DataFrame, col: str) -> DataFrame:
    """Rows with a key; null and '' are none."""
    return df.filter(F.col(col) != "")


def available(
    proxies: DataFrame, checks: DataFrame, keys: list[str], seq: list[str], max_secs: float = 2.0
) -> DataFrame:
    """Proxies whose test fetch returned 200 in time. A proxy may be listed many times."""
    good = checks.filter((F.col("status") == 200) & (F.col("elapsed") <= max_secs))
    good = good.select(F.struct(*keys).alias("_proxy")).distinct()
    listed = proxies.withColumn("_proxy", F.struct(*keys))
    return runtime.lookup(listed, good, "_proxy", seq, "left_semi").drop("_proxy")


# -- sets ------------------------------------------------------------------------------
def known_members(df: DataFrame, members: DataFrame, seq: list[str], key: str = "slug") -> DataFrame:
    """Rows whose key is in the set (unique on ``key``)."""
    return runtime.lookup(df, members.select(key), key, seq, "left_semi")


def unknown_members(df: DataFrame, members: DataFrame, seq: list[str], key: str = "slug") -> DataFrame:
    """Rows whose key is not in the set."""
    return runtime.lookup(df, members.select(key), key, seq, "left_anti")


def union_members(followers: DataFrame, followees: DataFrame, seq: list[str]) -> DataFrame:
    """Users of both endpoints, first write wins."""
    return first_write_wins(followers.unionByName(followees), "slug", seq)


def union_columns(contributed: DataFrame, following: DataFrame, seq: list[str]) -> DataFrame:
    """Columns of both endpoints, first write wins."""
    return first_write_wins(contributed.unionByName(following), "slug", seq)


def discoverable(columns: DataFrame, known: DataFrame) -> DataFrame:
    """Slugs found that are not known yet."""
    found = non_empty_key(columns, "slug").select("slug").distinct()
    return found.join(known.select("slug"), "slug", "left_anti")


# -- writes ----------------------------------------------------------------------------
def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: str, seq: list[str]
) -> DataFrame:
    """The rows to insert: first of their key, and the key not in the store. A row without a
    key can be told from no other, so it is not inserted; ``without_key`` gives those."""
    named = incoming.filter(F.col(key).isNotNull())
    return first_write_wins(named, key, seq).join(existing.select(key), key, "left_anti")


def without_key(incoming: DataFrame, key: str) -> DataFrame:
    """The rows that ``insert_if_absent`` cannot take, with their reason."""
    return incoming.filter(F.col(key).isNull()).withColumn("reject_reason", F.lit("no_key"))


def flag_new(existing: DataFrame, incoming: DataFrame, key: str, seq: list[str]) -> DataFrame:
    """All incoming rows with ``is_new``: true on the one row per key that is inserted.

    The inserted rows are found on key and order alone and joined back on the order, which
    is unique, so copies of one key do not meet in one task.
    """
    new = insert_if_absent(existing, incoming.select(key, *seq), key, seq)
    marks = new.select(*seq, F.lit(True).alias("_new"))
    return (
        incoming.join(marks, seq, "left")
        .withColumn("is_new", F.coalesce("_new", F.lit(False)))
        .drop("_new")
    )


def upsert_proxies(
    existing: DataFrame, incoming: DataFrame, seq: list[str], at: Column | str | None = None
) -> DataFrame:
    """Full snapshot: a known host becomes available and changes nothing else, a new host
    is inserted as available."""
    fresh = first_write_wins(incoming, "host", seq).select(
        "host",
        F.col("port").try_cast("int").alias("port"),
        keys.encode_protocol(F.col("protocol")).alias("protocol"),
    )
    new = assign_ids(fresh.join(existing.select("host"), "host", "left_anti"), existing, "host")
    new = keys.stamp(new, at).withColumn("available", F.lit(True))
    seen = fresh.select("host", F.lit(True).alias("_seen"))
    kept = (
        existing.join(seen, "host", "left")
        .withColumn("available", F.coalesce("_seen", "available"))
        .drop("_seen")
    )
    return kept.unionByName(new)


def mark_done(users: DataFrame, done: DataFrame, flag: str, key: str = "slug") -> DataFrame:
    """Full snapshot with the flag set for the keys in ``done``."""
    marks = done.select(key).distinct().withColumn("_done", F.lit(True))
    return (
        users.join(marks, key, "left").withColumn(flag, F.coalesce("_done", flag)).drop("_done")
    )


def dequeue(queue: DataFrame, done: DataFrame, key: str = "slug") -> DataFrame:
    """The queue without the used rows."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def pop_random(members: DataFrame, n: int, seed: int, key: str = "slug"):
    """(n members picked at random, the rest); a seed always picks the same ones."""
    pick = F.md5(F.concat(key, F.lit(str(seed))))
    popped = members.orderBy(pick, key).limit(n)
    return popped, members.join(popped.select(key), key, "left_anti")

"""Helpers that every operator shares: written intermediates and skew-proof lookups."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows of one key that a task of a salted join takes.
ROWS_PER_TASK = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach: the setting ``spark.checkpoint.dir``, or the
    checkpoint folder of the context. There is no default: intermediates of a machine's own
    folder are lost with it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return path


def new_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; nothing is ever written over."""
    return f"{shared_dir(spark).rstrip('/')}/crawlmart/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: work is not repeated by
    later readers, lineage is cut, and a lost executor costs nothing but a re-read."""
    path = new_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` and return its row count, taken in the same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, _salts): the keys with more rows than a task should take, and over how many
    parts to split each. There are at most rows / rows_per_task of them, however many keys
    there are, and the parts of all add up to less than twice that."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    salts = F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")
    return counts.filter(F.col("_n") > rows_per_task).select(key, salts)


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate for ``df`` is within the session's broadcast limit.

    It is the estimate by which Spark itself chooses a broadcast join; for a table read
    from files it comes from the size of the files.
    """
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread: list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join of ``facts`` to ``dim`` (unique on ``key``) that stays balanced when one
    key holds a large share of the facts.

    A ``dim`` within the broadcast limit is joined as it is. Beyond it, a key with more than
    ``rows_per_task`` facts is split over as many parts as it needs by a hash of ``spread``
    (columns that differ inside a key), and its one dimension row is repeated for each part.
    Null keys match nothing and are spread by the same hash. ``facts`` should be a written
    table: its keys are counted before it is joined.
    """
    if fits_broadcast(dim):
        return facts.join(dim, key, how)
    if hot is None:
        hot = hot_keys(facts, key, rows_per_task)
    hot = F.broadcast(hot)  # rows of facts / rows_per_task at most
    null_parts = F.lit(1 << 16)
    parts = F.when(F.col(key).isNull(), null_parts).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (
        facts.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), parts).cast("int"))
        .drop("_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = dim.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")

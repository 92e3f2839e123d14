"""Streaming ingest.

Every micro-batch writes one directory ``batch=<id>``. A replayed batch overwrites its own
directory and reads only smaller ids, so a restart gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from crawlmart.operators.keyed import insert_if_absent
from crawlmart.operators.summaries import new_article_feed
from crawlmart.sources.tables import COMMIT, write_table
from crawlmart.streaming.history import KeyHistory

STORE = -1


def _run(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _history(spark: SparkSession, path: str, key: str, kind: T.DataType) -> KeyHistory:
    """The stored keys of a table, beside its batches; readers of the table do not see it."""
    return KeyHistory(spark, f"{path}/_keys", key, kind)


def start_store(existing: DataFrame, path: str, key: str) -> None:
    """Write what is stored already, as the batch before the first, and its keys."""
    write_table(existing, path, STORE)
    _history(existing.sparkSession, path, key, existing.schema[key].dataType).start(existing)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, in_commits: bool = False
) -> DataFrame:
    """All batches of a table, with their number, and that of the commit if they have any."""
    more = [COMMIT] if in_commits else []
    batch = T.StructField("batch", T.IntegerType())
    return spark.read.schema(T.StructType([*schema.fields, *more, batch])).parquet(path)


def append_batches(
    stream: DataFrame, path: str, checkpoint: str, items: int = 0
) -> StreamingQuery:
    """Append every micro-batch, in commits of at most ``items`` rows (0: no commits)."""
    return _run(stream, lambda batch, no: write_table(batch, path, no, items), checkpoint)


def stream_insert_if_absent(
    stream: DataFrame,
    path: str,
    key: str,
    seq: list[str],
    checkpoint: str,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """First write wins over all batches and the store written by ``start_store``. A batch
    reads the stored keys that its own may meet (see ``history``).

    ``after`` gets the new rows of each batch, read back from what was committed.
    """
    schema = T.StructType(stream.schema.fields)

    def write(batch: DataFrame, no: int) -> None:
        spark = batch.sparkSession
        history = _history(spark, path, key, schema[key].dataType)
        history.roll_up(no)
        earlier = history.before(no, batch)
        write_table(insert_if_absent(earlier, batch, key, seq), path, no)
        new = spark.read.schema(schema).parquet(f"{path}/batch={no}")
        history.add(new, no)
        if after is not None:
            after(new, no)

    return _run(stream, write, checkpoint)


def stream_batch_feed(
    stream: DataFrame, path: str, key: str, seq: list[str], checkpoint: str, feed: str, base: str
) -> StreamingQuery:
    """``stream_insert_if_absent`` that also publishes links and keys of each batch's new
    rows. Needs the columns md5 and token."""

    def publish(new: DataFrame, no: int) -> None:
        write_table(new_article_feed(new, base, seq=seq), feed, no)

    return stream_insert_if_absent(stream, path, key, seq, checkpoint, publish)


def stream_dedupe(
    stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Rows with a key not seen before. With an event time and a delay the memory of seen
    keys is bounded: copies are recognised within the delay."""
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_last_update(stream: DataFrame, column: str, time: str) -> DataFrame:
    """Running latest time per column; run it in update mode."""
    return stream.groupBy(column).agg(F.max(time).alias("last_update_time"))


def write_updates(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed rows of each micro-batch."""
    return _run(updates, lambda batch, no: write_table(batch, path, no), checkpoint, "update")

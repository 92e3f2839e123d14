"""Streams against batch, and replay of a micro-batch."""

import shutil
from pathlib import Path

from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.operators import keyed
from crawlmart.streaming import ingest

KEYS = [[3, 1, 3], [1, 2, 2, 4], [5, 3, 0], [6, 1, 6]]
SCHEMA = "seq long, key string"


def land(spark, src, rows, start):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
    start(spark.readStream.schema(SCHEMA).parquet(src)).awaitTermination()


def arrivals():
    rows, seq = [], 0
    for keys in KEYS:
        rows.append([(seq + i, f"k{k}") for i, k in enumerate(keys)])
        seq += len(keys)
    return rows


def read(spark, path):
    rows = ingest.read_batches(spark, path, spark.createDataFrame([], SCHEMA).schema)
    return sorted(tuple(r) for r in rows.select("key", "seq", "batch").collect())


def test_stream_equals_batch_and_survives_a_replay(spark):
    src, path, checkpoint, crashed = (runtime.new_dir(spark, n) for n in ("src", "out", "cp", "crash"))
    existing = spark.createDataFrame([(-1, "k0")], SCHEMA)
    ingest.start_store(existing, path, "key")
    start = lambda cp: lambda stream: ingest.stream_insert_if_absent(stream, path, "key", ["seq"], cp)
    for rows in arrivals():
        land(spark, src, rows, start(checkpoint))
    every = spark.createDataFrame([r for rows in arrivals() for r in rows], SCHEMA)
    once = keyed.insert_if_absent(existing, every, "key", ["seq"]).collect()
    first = read(spark, path)
    assert sorted((k, s) for k, s, b in first if b >= 0) == sorted((r.key, r.seq) for r in once)
    # The state after a crash: the last batch is planned and written but not committed.
    shutil.copytree(
        checkpoint.removeprefix("file:"), crashed.removeprefix("file:"),
        ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".crc") == "3"],
    )
    assert not Path(crashed.removeprefix("file:"), "commits", "3").exists()
    start(crashed)(spark.readStream.schema(SCHEMA).parquet(src)).awaitTermination()
    assert read(spark, path) == first


def test_dedupe_within_watermark(spark):
    src, path, checkpoint = (runtime.new_dir(spark, n) for n in ("src", "out", "cp"))

    def start(stream):
        timed = stream.withColumn("ts", F.timestamp_seconds("seq"))
        return ingest.append_batches(ingest.stream_dedupe(timed, "key", "ts", "1 hour").drop("ts"), path, checkpoint)

    for rows in arrivals():
        land(spark, src, rows, start)
    got = read(spark, path)
    assert len(got) == len({k for k, _, _ in got}) == 7


def test_feed_of_a_batch(spark):
    src, path, checkpoint, feed = (runtime.new_dir(spark, n) for n in ("src", "out", "cp", "feed"))
    named = lambda df: df.withColumns({"token": F.col("key"), "md5": F.md5("key")})
    ingest.start_store(named(spark.createDataFrame([], SCHEMA)), path, "md5")
    for rows in arrivals():
        land(spark, src, rows, lambda stream: ingest.stream_batch_feed(
            named(stream), path, "md5", ["seq"], checkpoint, feed, "B"))
    rows = spark.read.schema("n_new int, links string, batch int").parquet(feed).orderBy("batch").collect()
    assert [r.n_new for r in rows] == [2, 2, 2, 1]
    assert rows[0].links == "B/article/k3\nB/article/k1"


def test_commits_lie_together_in_few_files(spark):
    """Two thousand commits are no two thousand files."""
    src, path, checkpoint = (runtime.new_dir(spark, n) for n in ("src", "out", "cp"))
    rows = spark.range(20_003).select(F.col("id").alias("seq"), F.concat(F.lit("k"), "id").alias("key"))
    rows.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    ingest.append_batches(stream, path, checkpoint, 10).awaitTermination()
    assert len(list(Path(path.removeprefix("file:")).glob("batch=0/*.parquet"))) <= 3
    schema = spark.createDataFrame([], SCHEMA).schema
    stored = ingest.read_batches(spark, path, schema, in_commits=True)
    assert sorted(r.seq for r in stored.select("seq").collect()) == list(range(20_003))
    placed = stored.select("commit", F.input_file_name().alias("file"))
    made = placed.groupBy("commit").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files")).collect()
    assert {r.files for r in made} == {1}
    assert max(r.n for r in made) == 10
    assert sum(r.n < 10 for r in made) <= 3  # the last one of each task
    assert ingest.read_batches(spark, path, schema).columns == ["seq", "key", "batch"]

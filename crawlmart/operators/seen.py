"""Keys that were seen before: a bitmap of bounded size before the exact set."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime

BITS = 32768  # of a block: what bitmap_construct_agg gives
MOST_BLOCKS = 2048  # 8 MB in all, so it may be broadcast however many keys there are
KEYS_PER_BLOCK = BITS // 12
PROBES = 4


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("_block")


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(PROBES)]


def _bit(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1


@dataclass
class SeenKeys:
    """A set of keys, and a Bloom filter over it in blocks: all places of a key lie in one.

    Up to ``KEYS_PER_BLOCK * MOST_BLOCKS`` keys, below one key in a hundred that is not in the
    set passes the filter. With more keys more pass, and the exact join has more to do;
    the result is the same.
    """

    key: str
    exact: DataFrame
    blocks: DataFrame
    n_blocks: int

    def maybe(self, df: DataFrame) -> DataFrame:
        """``df`` with a flag ``_maybe``: false for rows whose key is certainly not in the set.
        Nothing but the filter moves. A null key is in no set."""
        key = F.col(self.key)
        looked = df.withColumn("_block", _block(key, self.n_blocks)).join(
            F.broadcast(self.blocks), "_block", "left"
        )
        hit = key.isNotNull()
        for place in _places(key):
            hit = hit & _bit(F.col("_bits"), place)
        return looked.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_block", "_bits")

    def unseen(self, df: DataFrame, spread: list[str]) -> DataFrame:
        """The rows whose key is not in the set. Rows that the filter settles stay where they
        are; of the others the keys alone meet the exact set, once each, and only those that
        are not in it fetch their rows. ``spread`` as in ``runtime.lookup``."""
        marked = self.maybe(df)
        sure = marked.filter(~F.col("_maybe")).drop("_maybe")
        doubtful = marked.filter("_maybe").drop("_maybe")
        alarms = doubtful.select(self.key).distinct().join(self.exact, self.key, "left_anti")
        alarms = runtime.materialize(alarms, "alarms")
        return sure.unionByName(runtime.lookup(doubtful, alarms, self.key, spread, "left_semi"))


def seen_keys(keys: DataFrame, key: str, n_blocks: int | None = None) -> SeenKeys:
    """The set of ``keys`` (repeated and null ones count for nothing), written once. The number
    of blocks follows from the number of keys."""
    spark = keys.sparkSession
    path = runtime.new_dir(spark, "seen")
    once = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    n = runtime.write_counted(once, path)
    exact = spark.read.schema(once.schema).parquet(path)
    n_blocks = n_blocks or min(MOST_BLOCKS, max(1, math.ceil(n / KEYS_PER_BLOCK)))
    # Places are dealt by block before they are put into bitmaps: a task that held a few keys
    # of every block would otherwise send 4 KB for each.
    places = exact.select(
        _block(F.col(key), n_blocks), F.explode(F.array(*_places(F.col(key)))).alias("place")
    )
    bits = F.bitmap_construct_agg("place").alias("_bits")
    blocks = places.repartition("_block").groupBy("_block").agg(bits)
    return SeenKeys(key, exact, runtime.materialize(blocks, "blocks"), n_blocks)

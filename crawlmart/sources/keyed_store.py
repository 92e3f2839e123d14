"""Tables that lie in folders by a hash of their key (U1 on large stores).

A batch of keys meets few of the folders, or only some rows of each. So a load reads the
folders that its keys fall into, and of the stored rows only those with a key of the batch
go on: the keys of a batch are sent to the store, not the store's keys to the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmart.operators.keyed import insert_if_absent
from crawlmart.sources.tables import complete_batches, mark_complete

PREFIX = "prefix"


def prefix_of(key: str | Column, digits: int) -> Column:
    """First digits of the key's md5: even whatever the keys look like."""
    return F.substring(F.md5(F.col(key).cast("string") if isinstance(key, str) else key), 1, digits)


@dataclass(frozen=True)
class KeyedStore:
    """A stored table, unique on ``key``, with ``16 ** digits`` folders in each batch. Rows
    without a key are not stored."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    digits: int = 2

    def write(self, rows: DataFrame, batch: int) -> None:
        """Store a batch, one file a folder. A repeated batch replaces its own rows only;
        readers see a batch when it is complete."""
        named = rows.select(*self.schema.fieldNames()).filter(F.col(self.key).isNotNull())
        dealt = named.withColumn(PREFIX, prefix_of(self.key, self.digits)).repartition(PREFIX)
        dealt.write.mode("overwrite").partitionBy(PREFIX).parquet(f"{self.path}/batch={batch}")
        mark_complete(self.spark, self.path, batch)

    def read(self) -> DataFrame:
        """All stored rows, with their folder."""
        parts = [T.StructField("batch", T.IntegerType()), T.StructField(PREFIX, T.StringType())]
        layout = T.StructType([*self.schema.fields, *parts])
        paths = [f"{self.path}/batch={n}" for n in complete_batches(self.spark, self.path)]
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).option("basePath", self.path).parquet(*paths)

    def near(self, incoming: DataFrame) -> DataFrame:
        """The stored rows whose key is in ``incoming`` (first column, a written table).

        The names of the folders in question come to the driver, 16 ** digits at most. A small
        batch is broadcast by Spark; then no stored row is shuffled at all.
        """
        keys = incoming.select(F.col(incoming.columns[0]).alias(self.key)).distinct()
        met = keys.select(prefix_of(self.key, self.digits).alias(PREFIX)).distinct().collect()
        folders = [r[PREFIX] for r in met if r[PREFIX] is not None]
        stored = self.read().filter(F.col(PREFIX).isin(folders)) if folders else self.read().limit(0)
        return stored.join(keys, self.key, "left_semi").select(*self.schema.fieldNames())

    def insert_if_absent(self, incoming: DataFrame, seq: list[str]) -> DataFrame:
        """The rows of ``incoming``, a written table, to insert: first of their key, and the
        key not stored."""
        known = self.near(incoming.select(self.key))
        return insert_if_absent(known, incoming, self.key, seq)

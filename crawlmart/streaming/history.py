"""The keys that a stream has stored, kept so that a batch reads few of them.

Keys lie beside the batches in runs. A run of level 0 holds the new keys of one batch. Every
``fan`` runs of a level are rolled up into one of the next, in folders by a hash of the key,
one file a folder. Which runs stand for the batches before a number follows from the number
alone: its digits to the base ``fan``. So a batch reads fan - 1 runs a level at most, of the
rolled ones only the folders that its keys fall into, and a replayed batch reads the same runs
and writes the same ones again. A key is written once a level, and there are log(batches) of
those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmart.sources.keyed_store import PREFIX, prefix_of


FOLDER_KEYS = 1_000_000


@dataclass(frozen=True)
class KeyHistory:
    spark: SparkSession
    path: str
    key: str
    kind: T.DataType  # of the key
    fan: int = 8

    @property
    def digits(self) -> int:
        """Of the hash that names a folder; settled when the stored keys were counted."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/base")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [entry.getPath().getName() for entry in files.listStatus(root)]
        return next(int(n.removeprefix("digits=")) for n in names if n.startswith("digits="))

    def _run(self, level: int, number: int) -> str:
        return f"{self.path}/level={level}/run={number}"

    def runs_before(self, batch: int) -> list[tuple[int, int]]:
        """(level, number) of the runs that together hold the batches before one."""
        level, found, left = 0, [], batch
        while left:
            left, digit = divmod(left, self.fan)
            found += [(level, left * self.fan + k) for k in range(digit)]
            level += 1
        return found

    def start(self, stored: DataFrame) -> None:
        """The keys that are stored before the first batch: there are as many folders, in
        powers of 16, as keep a folder at about FOLDER_KEYS of them."""
        n, digits = stored.count(), 1
        while n > FOLDER_KEYS * 16**digits:
            digits += 1
        self._write_folders(stored.select(self.key), f"{self.path}/base/digits={digits}", digits)

    def _write_folders(self, keys: DataFrame, path: str, digits: int) -> None:
        keys = keys.filter(F.col(self.key).isNotNull())
        dealt = keys.withColumn(PREFIX, prefix_of(self.key, digits)).repartition(PREFIX)
        dealt.write.mode("overwrite").partitionBy(PREFIX).parquet(path)

    def _read(self, level: int, numbers: list[int]) -> DataFrame:
        """Runs of one level, with the folder of each key if they have folders."""
        fields = [T.StructField(self.key, self.kind), T.StructField("run", T.LongType())]
        if level:
            fields.append(T.StructField(PREFIX, T.StringType()))
        rows = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/level={level}")
        return rows.parquet(*[self._run(level, k) for k in numbers])

    def add(self, keys: DataFrame, batch: int) -> None:
        """The new keys of a batch, in few files."""
        keys.select(self.key).write.mode("overwrite").parquet(self._run(0, batch))

    def roll_up(self, batch: int) -> None:
        """What is due before a batch: the runs that its number completes, lowest first."""
        level, size = 1, self.fan
        while batch and batch % size == 0:
            number = batch // size - 1
            below = self._read(level - 1, [number * self.fan + k for k in range(self.fan)])
            self._write_folders(below.select(self.key), self._run(level, number), self.digits)
            level, size = level + 1, size * self.fan

    def before(self, batch: int, incoming: DataFrame) -> DataFrame:
        """The keys stored before a batch that may be among those of ``incoming``.

        The folders in question come to the driver: 16 ** digits names at most."""
        digits = self.digits
        met = incoming.filter(F.col(self.key).isNotNull())
        met = met.select(prefix_of(self.key, digits).alias(PREFIX)).distinct().collect()
        folders = [r[PREFIX] for r in met]
        field = T.StructField(self.key, self.kind)
        layout = T.StructType([field, T.StructField(PREFIX, T.StringType())])
        inside = F.col(PREFIX).isin(folders)
        base = self.spark.read.schema(layout).parquet(f"{self.path}/base/digits={digits}")
        found = base.filter(inside).select(self.key)
        runs = self.runs_before(batch)
        for level in sorted({level for level, _ in runs}):
            rows = self._read(level, [k for on, k in runs if on == level])
            rows = rows.filter(inside) if level else rows
            found = found.unionByName(rows.select(self.key))
        return found

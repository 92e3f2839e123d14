"""Commits of n items inside a stream.

Items are numbered through all micro-batches in their order, and every ``n`` of them are a
commit. A commit may begin in one micro-batch and end in a later one; it counts when its last
item is stored, and then has a mark, with its links and keys, which is its feed. The last,
smaller commit is made when the stream is closed. Rows of a commit without a mark are not read.

Numbers follow from the batches before and the order of the items, so a micro-batch that is
replayed writes the same commits again, in place of its own rows only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from crawlmart.operators.keyed import number_rows
from crawlmart.streaming.ingest import _run

MARK = "commit long, n_rows long, items array<string>"


@dataclass(frozen=True)
class Commits:
    """Commits of ``n`` rows in the order of ``seq`` (total), under ``path``. ``item`` is the
    column whose values a commit's mark lists."""

    spark: SparkSession
    path: str
    schema: T.StructType
    n: int
    seq: list[str]
    item: str

    def _layout(self) -> T.StructType:
        more = [T.StructField("rn", T.LongType()), T.StructField("commit", T.LongType())]
        return T.StructType([*self.schema.fields, *more, T.StructField("batch", T.IntegerType())])

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._layout()).parquet(f"{self.path}/rows")

    def _stored_before(self, batch: int) -> int:
        """Rows of the micro-batches before one."""
        if batch == 0:
            return 0
        last = self._rows().filter(F.col("batch") < batch).agg(F.max("rn")).first()[0]
        return last or 0

    def _marks(self, rows: DataFrame) -> DataFrame:
        """The marks of the commits that these rows make up; a commit has n rows at most."""
        told = F.sort_array(F.collect_list(F.struct("rn", F.col(self.item).cast("string").alias("item"))))
        marks = rows.groupBy("commit").agg(F.count(F.lit(1)).alias("n_rows"), told.alias("items"))
        return marks.select("commit", "n_rows", F.col("items.item").alias("items"))

    def write(self, batch: DataFrame, no: int) -> None:
        """Store a micro-batch, then the marks of the commits that it completes."""
        before = self._stored_before(no)
        numbered = number_rows(batch.select(*self.schema.fieldNames()), self.seq)
        numbered = numbered.withColumn("rn", F.col("rn").cast("long") + F.lit(before))
        rows = numbered.withColumn("commit", F.floor((F.col("rn") - 1) / self.n).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch={no}")
        upto = self._rows().filter(F.col("batch") <= no)
        after = self._stored_before(no + 1)
        first, end = before // self.n, after // self.n  # commits that are whole now, not before
        done = upto.filter((F.col("commit") >= first) & (F.col("commit") < end))
        self._marks(done).write.mode("overwrite").parquet(f"{self.path}/marks/batch={no}")

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return _run(stream, self.write, checkpoint)

    def close(self) -> None:
        """Make the last commit, if rows are left. A stream that goes on is closed again."""
        last = self._rows().agg(F.max("commit")).first()[0]
        if last is not None:
            rows = self._rows().filter(F.col("commit") == last)
            marks = self._marks(rows).filter(F.col("n_rows") < self.n)
            marks.write.mode("overwrite").parquet(f"{self.path}/closing")

    def marks(self) -> DataFrame:
        """commit, n_rows and items of every commit, one row each."""
        layout = MARK + ", batch int"
        found = self.spark.read.schema(layout).parquet(f"{self.path}/marks").drop("batch")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/closing")
        if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            closing = self.spark.read.schema(MARK).parquet(f"{self.path}/closing")
            # Once a later micro-batch has completed it, the commit has its own mark.
            found = found.unionByName(closing.join(found.select("commit"), "commit", "left_anti"))
        return found

    def read(self) -> DataFrame:
        """The rows of all commits that are made."""
        marks = self.marks().select("commit")
        return self._rows().join(marks, "commit", "left_semi").select(*self.schema.fieldNames(), "commit")

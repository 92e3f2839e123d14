"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds what a Python worker gets at once: texts of very different lengths travel in
    batches of about ``size``, not of a number of rows. A session's own setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's default
        spark.conf.set(key, size)


def words_of(text: Column) -> Column:
    """Words of a text: runs of anything but the six ASCII blanks. Null gives no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


FAN = 64  # arrays that one task adds up


def added_up(
    counted: DataFrame,
    key: str,
    add: Callable[[pa.Table], pa.Table],
    schema: str,
    last: Callable[[pa.Table], pa.Table] = lambda table: table,
) -> DataFrame:
    """One row per ``key`` from the rows of all tasks, by ``add`` of the rows of one group, in
    rounds: no group holds the rows of more than FAN tasks, however many there are. ``last``
    changes the sums, in the same Python worker as the last round."""
    tasks = counted.rdd.getNumPartitions()
    rows = counted.withColumn("task", F.spark_partition_id())

    def some(table: pa.Table) -> pa.Table:
        task = table.column("task").slice(0, 1)
        return add(table.drop_columns("task")).append_column("task", task)

    while tasks > FAN:
        tasks = -(-tasks // FAN)
        rows = rows.withColumn("task", F.floor(F.col("task") / FAN).cast("int"))
        rows = rows.groupBy(key, "task").applyInArrow(some, f"{schema}, task int")
    return rows.drop("task").groupBy(key).applyInArrow(lambda table: last(add(table)), schema)


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each computed once for a row.

    Catalyst puts the expression of a column in place of its name, also inside a lambda,
    where it would then run for each element. It does not do so through an explode.
    """
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def shelved(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed, and their new names, so that an operator's own
    columns clash with none."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(df: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` from the renamed ones, with a new text; n_chars follows it."""
    new = {"text": text, "n_chars": F.length(text)}
    return df.select(
        *[
            new.get(c, F.col(f"in_{i}")).cast(kind).alias(c)
            for i, (c, kind) in enumerate(docs.dtypes)
        ]
    )


def running(
    df: DataFrame, group: list[str], cell: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over a group's rows before this one, in the order
    of ``cell``, then ``order``. A task orders one cell, or one group's cells, never a group.
    """
    sums = df.groupBy(*group, cell).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, cell).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = sums.select(
        *group, cell, F.coalesce(F.sum("_sum").over(before), zero).alias("_start")
    )
    local = F.coalesce(F.sum(value).over(inside), zero)
    return df.join(starts, [*group, cell]).withColumn(name, F.col("_start") + local).drop("_start")

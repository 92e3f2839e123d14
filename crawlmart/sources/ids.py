"""Ids that two loads at once cannot both give.

A ledger holds one small file per reservation, numbered 0, 1, 2 … Each tells which ids a load
has taken. The next file is written under a name of its own and then renamed to the next
number, which fails if another load was faster; then the load looks again. So ranges never
overlap, whatever the loads have read of the store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class IdLedger:
    """Reservations under ``path``, a folder for each table."""

    spark: SparkSession
    path: str

    def _paths(self):
        jvm = self.spark._jvm
        return jvm, jvm.org.apache.hadoop.fs.Path

    def entries(self, table: str) -> list[dict]:
        """The reservations of a table, in order: load, before (the id before its first), n."""
        jvm, path = self._paths()
        folder = path(f"{self.path}/{table}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(folder)]
        found = []
        for name in sorted(n for n in names if n.isdigit()):
            stream = files.open(path(f"{self.path}/{table}/{name}"))
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            found.append(json.loads(text))
        return found

    def reserve(self, table: str, load: str, n: int) -> int:
        """The id before the first of ``n`` ids that are the load's alone. A load that asks
        again for as many, as after a failure, gets the same ones."""
        while True:
            known = self.entries(table)
            for entry in known:
                if load and (entry["load"], entry["n"]) == (load, n):
                    return entry["before"]
            before = known[-1]["before"] + known[-1]["n"] if known else 0
            if self._write(table, len(known), {"load": load, "before": before, "n": n}):
                return before

    def of(self, table: str, load: str) -> Callable[[int], int]:
        """``reserve`` for one table and load."""
        return lambda n: self.reserve(table, load, n)

    def _write(self, table: str, number: int, entry: dict) -> bool:
        """Whether this entry became the one of its number."""
        jvm, path = self._paths()
        configuration = self.spark._jsc.hadoopConfiguration()
        made = path(f"{self.path}/{table}/.{uuid.uuid4().hex}")
        files = made.getFileSystem(configuration)
        stream = files.create(made, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        none = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        options = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1
        )
        options[0] = none
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), configuration)
        try:
            context.rename(made, path(f"{self.path}/{table}/{number:012d}"), options)
        except Exception as error:  # noqa: BLE001 - of the JVM; its class tells what it is
            files.delete(made, False)
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        return True

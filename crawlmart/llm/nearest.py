"""Nearest neighbours by inner product: a block matrix join with int8 tiles.

Queries and candidates are cut into blocks; each pair of blocks is one tile. A tile multiplies
int8 copies of the vectors, which gives every inner product up to a bound that follows from
what rounding took away. Only pairs whose upper bound reaches the k-th best lower bound are
computed again from the original components, in double precision and in their order, and go
through a heap for each query. So the result is exact, not only near.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part; vectors of different lengths are never compared; a query does not
find rows with its own id; a query id that occurs several times counts once, with its least
vector; equal candidates are found as often as they occur; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS = 4096  # candidates of a tile, about
QUERIES = 1024  # queries of a tile, about
STRIP = 256  # queries of a tile that are worked on together
HEAPS = 50_000  # queries that a task keeps open at most

BLOCK = "ids binary, exact binary, small binary, step binary, norm binary, lost binary"
NAMES = ["ids", "exact", "small", "step", "norm", "lost"]


def valid(df: DataFrame, id_: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = df.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """One row per block: dims, block, and its vectors exact and in int8; and how many blocks.

    Blocks are dealt by a hash of the row, so they are even whatever the ids."""
    n = max(1, -(-rows.count() // size))
    dealt = rows.select(
        F.size("v").alias("dims"), F.pmod(F.xxhash64("id", "v"), F.lit(n)).alias("block"), "id", "v"
    )

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v = v.reshape(len(ids), -1)
        order = np.lexsort((*v.T[::-1], ids))  # the same block whatever order rows come in
        ids, v = ids[order], v[order]
        step = np.abs(v).max(axis=1) / 127
        small = np.rint(v / step[:, None]).astype(np.int8)
        near = small * step[:, None]
        lost = np.linalg.norm(v - near, axis=1)
        parts = (ids, v, small, step, np.linalg.norm(near, axis=1), lost)
        raw = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]
        return pa.table(
            [table.column("dims").slice(0, 1), table.column("block").slice(0, 1), *raw],
            ["dims", "block", *NAMES],
        )

    schema = f"dims int, block long, {BLOCK}"
    return dealt.groupBy("dims", "block").applyInArrow(pack, schema), n


class _Block:
    def __init__(self, row: dict, prefix: str, dims: int):
        raw = {x: row[prefix + x] for x in NAMES}
        self.ids = np.frombuffer(raw["ids"], np.int64)
        self.v = np.frombuffer(raw["exact"], np.float64).reshape(-1, dims)
        # Products of int8 stay exact in 32-bit floats up to this many of them.
        kind = np.float32 if dims * 127 * 127 < 1 << 24 else np.float64
        self.small = np.frombuffer(raw["small"], np.int8).reshape(-1, dims).astype(kind)
        self.step, self.norm, self.lost = (
            np.frombuffer(raw[x], np.float64) for x in ("step", "norm", "lost")
        )


def _tile(q: _Block, c: _Block, k: int, heaps: dict[int, list]) -> None:
    for low in range(0, len(q.ids), STRIP):
        at = slice(low, low + STRIP)
        near = (q.small[at] @ c.small.T).astype(np.float64)
        near *= q.step[at, None] * c.step[None, :]
        bound = q.norm[at, None] * c.lost[None, :]
        bound += q.lost[at, None] * (c.norm + c.lost)[None, :]
        bound *= 1 + 1e-9
        bound += 1e-12 * q.norm[at, None] * c.norm[None, :]
        own = q.ids[at, None] == c.ids[None, :]
        near[own] = -np.inf
        lower = near - bound
        if lower.shape[1] > k:
            least = np.partition(lower, -k, axis=1)[:, -k]
        else:
            least = np.full(len(lower), -np.inf)
        full = [heaps.get(x, ()) for x in q.ids[at].tolist()]
        best = [h[0][0] if len(h) == k else -np.inf for h in full]
        i, j = np.nonzero((near + bound >= np.maximum(least, best)[:, None]) & ~own)
        score = np.zeros(len(i))
        for d in range(q.v.shape[1]):
            score += q.v[low + i, d] * c.v[j, d]
        for x, s, y in zip(q.ids[low + i].tolist(), score.tolist(), c.ids[j].tolist(), strict=True):
            heap = heaps.setdefault(x, [])
            if len(heap) < k:
                heapq.heappush(heap, (s, -y))
            elif (s, -y) > heap[0]:
                heapq.heapreplace(heap, (s, -y))


def nearest(
    queries: DataFrame, candidates: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), id and score of the k nearest of each query."""
    wanted = valid(queries, id_, vector).groupBy("id").agg(F.min("v").alias("v"))
    q, n_q = blocks(wanted, QUERIES)
    c, n_c = blocks(valid(candidates, id_, vector), ROWS)
    q = q.select("dims", F.col("block").alias("j"), *[F.col(x).alias("q_" + x) for x in NAMES])
    c = c.select("dims", F.col("block").alias("i"), *[F.col(x).alias("c_" + x) for x in NAMES])
    zero = F.lit(0).cast("long")
    q = q.withColumn("i", F.explode(F.sequence(zero, F.lit(n_c - 1).cast("long"))))
    c = c.withColumn("j", F.explode(F.sequence(zero, F.lit(n_q - 1).cast("long"))))
    tiles = q.join(c, ["dims", "i", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}

        def flush() -> pa.RecordBatch:
            found = [(x, -y, s) for x, heap in heaps.items() for s, y in heap]
            heaps.clear()
            columns = zip(*found, strict=True) if found else ((), (), ())
            kinds = (pa.int64(), pa.int64(), pa.float64())
            arrays = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["query_id", "id", "score"])

        for batch in batches:
            for k_ in range(batch.num_rows):
                row = {x: batch.column(x)[k_].as_py() for x in batch.schema.names}
                _tile(_Block(row, "q_", row["dims"]), _Block(row, "c_", row["dims"]), k, heaps)
                if len(heaps) > HEAPS:
                    yield flush()
        yield flush()

    found = tiles.mapInArrow(run, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")

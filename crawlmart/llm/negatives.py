"""Hard negatives: for an anchor and each of its positives, rows of other labels that come
close to the positive's score without passing it.

Vectors become integers, so that scores are exact. A tile of scores is a product of matrices
in a residue number system: the matrices are reduced modulo several small primes, multiplied
in 32-bit floats (a sum of so many products stays below 2**24, where these are exact), and the
signed scores follow from the residues by Chinese remaindering in mixed radix. How many primes
a tile takes follows from its largest possible score.

Anchors meet all rows twice, in a grid of strips: first for the best rows of the anchor's
label, then, once the positives are known, for the best rows of other labels in the window
below each positive's score. A task holds two strips. There are about sqrt(cells) strips on
a side, more of anchors as their lists weigh more, so a strip is sent to about that many cells
and what is shuffled grows with the square root of their number, not with the number itself.

Defined results: rows with a null id or label, a null vector, a null or non-finite component
take no part, nor do rows whose squared length is beyond 64 bits, as their scores would be;
vectors of different lengths are never compared; equal rows count once; a row with the anchor's
own id is neither positive nor negative of it, and several rows with one id are each a row; an
anchor without positives, and a positive without negatives, have no rows. A positive of
negative score has no window. Tables may be empty, and further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm.common import small_batches

EXACT = 1 << 24  # up to here 32-bit floats hold every integer
DIMENSIONS = 4096  # of which products are added up before they are reduced
TILE = 1 << 20  # scores that are worked on together
CELL_BYTES = 48 << 20  # of vectors in a cell, about


@dataclass(frozen=True)
class Window_:
    """Shares of the positive's score, in hundredths, between which a negative's lies."""

    low: int = 80
    high: int = 100


# -- residues --------------------------------------------------------------------------
def primes_for(dimensions: int, bound: int) -> list[int]:
    """The largest primes whose residues multiply exactly over so many dimensions, as many as
    tell all scores of magnitude up to ``bound`` apart."""
    half = math.isqrt((EXACT - 1) // max(1, min(dimensions, DIMENSIONS)))
    found, product, p = [], 1, 2 * half + 1
    while product <= 2 * bound:
        if p < 3:
            raise ValueError("no primes are left")
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, between -p/2 and p/2, as 32-bit floats."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _reduced(x: np.ndarray, p: int) -> np.ndarray:
    """The same for 32-bit floats that hold integers below 2**24."""
    x -= np.float32(p) * np.rint(x * np.float32(1 / p))
    return x


def products(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """a @ b.T, exactly, if no entry is beyond half the product of the primes (and 63 bits)."""
    parts = []
    for p in primes:
        total = np.zeros((len(a), len(b)), np.float32)
        for k in range(0, a.shape[1], DIMENSIONS):
            at = slice(k, k + DIMENSIONS)
            total += _reduced(_residues(a[:, at], p) @ _residues(b[:, at], p).T, p)
            total = _reduced(total, p)
        parts.append(total)
    # Mixed radix: score = d0 + d1 p0 + d2 p0 p1 + ..., each digit from the residue that the
    # digits before it leave. Digits lie around zero, so the sum has the score's sign; it is
    # taken modulo 2**64, which the score fits.
    score = np.zeros((len(a), len(b)), np.int64)
    digits: list[np.ndarray] = []
    weight = 1
    for k, (p, r) in enumerate(zip(primes, parts, strict=True)):
        for q, digit in zip(primes[:k], digits, strict=True):
            # (r - digit) / q modulo p; both factors are below p in magnitude.
            r = _reduced(_reduced(r - digit, p) * np.float32(_centred(pow(q, -1, p), p)), p)
        r = r - np.float32(p) * (r > p // 2) + np.float32(p) * (r < -(p // 2))
        digits.append(r)
        wrapped = weight % (1 << 64)
        step = np.uint64(wrapped).astype(np.int64) if wrapped >= 1 << 63 else np.int64(wrapped)
        with np.errstate(over="ignore"):
            score += r.astype(np.int64) * step
        weight *= p
    return score


def _centred(x: int, p: int) -> int:
    return x - p if x > p // 2 else x


# -- rows ------------------------------------------------------------------------------
ROW = "vec_id long, label long, dims int, vec binary"
_WIDTHS = ((np.int8, 1), (np.int16, 2), (np.int32, 4), (np.int64, 8))


def packed(rows: DataFrame, id_: str, label: str, vector: str, scale: float) -> DataFrame:
    """``ROW`` of the rows that take part: floor(scale * component) of each, in as few bytes
    as its largest takes. Equal rows are one."""
    small_batches(rows.sparkSession)
    rows = rows.select(
        F.col(id_).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    rows = rows.filter("vec_id is not null and label is not null and v is not null")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            bad = flat.is_null().to_numpy(zero_copy_only=False)
            values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values * scale)
                square = values * values
            bad |= ~np.isfinite(values)
            of = np.repeat(np.arange(len(sizes)), sizes)
            spoilt = np.bincount(of, bad, len(sizes)) > 0
            square[bad] = 0
            spoilt |= np.bincount(of, square, len(sizes)) >= 2.0**62
            values = np.where(bad | spoilt[of], 0, values)
            most = np.zeros(len(sizes))
            np.maximum.at(most, of, np.abs(values))
            starts = np.cumsum(sizes) - sizes
            raw: list[bytes | None] = [None] * len(sizes)
            for k in np.flatnonzero(~spoilt).tolist():
                kind = next(t for t, w in _WIDTHS if most[k] < 1 << (8 * w - 1))
                raw[k] = values[starts[k] : starts[k] + sizes[k]].astype(kind).tobytes()
            keep = pa.array(~spoilt)
            columns = [
                batch.column("vec_id"), batch.column("label"),
                pa.array(sizes, pa.int32()), pa.array(raw, pa.binary()),
            ]
            full = pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "dims", "vec"])
            yield full.filter(keep)

    return rows.mapInArrow(pack, ROW).distinct()


def _matrix(raw: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """The vectors of some rows, one per line."""
    out = np.zeros((len(raw), dims), np.int64)
    for k, x in enumerate(raw.to_pylist()):
        if dims:
            out[k] = np.frombuffer(x, dict((w, t) for t, w in _WIDTHS)[len(x) // dims])
    return out


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """No score of the two strips is beyond this."""
    return math.isqrt(_square(a)) * math.isqrt(_square(b)) + 1


def _square(a: np.ndarray) -> int:
    """A little over the largest squared length."""
    real = a.astype(np.float64)
    return int((real * real).sum(axis=1).max(initial=0.0) * (1 + 1e-9)) + 2 * int(
        math.isqrt(int((real * real).sum(axis=1).max(initial=0.0)) + 1)
    ) + 4


# -- the grid --------------------------------------------------------------------------
def grid(n_anchors: int, n_rows: int, row_bytes: float, least_cells: int) -> tuple[int, int]:
    """Strips of anchors and strips of rows: at least so many cells, none over CELL_BYTES, and
    the least to be shuffled. An anchor also weighs what its lists in a cell take."""
    a_bytes, r_bytes = n_anchors * (row_bytes + 600), n_rows * row_bytes
    cells = max(1, least_cells)
    while True:
        # a_bytes * strips of rows + r_bytes * strips of anchors is least where both are equal.
        on_a = max(1, round(math.sqrt(cells * a_bytes / max(1.0, r_bytes))))
        on_a = min(on_a, cells, max(1, n_anchors))
        on_r = max(1, min(-(-cells // on_a), max(1, n_rows)))
        if a_bytes / on_a + r_bytes / on_r <= CELL_BYTES or on_a * on_r >= n_anchors * n_rows:
            return on_a, on_r
        cells *= 2


def _cells(anchors: DataFrame, rows: DataFrame, n_a: int, n_r: int):
    """Both sides dealt over the grid."""

    def strips(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    a = anchors.withColumn("x", F.pmod(F.xxhash64("anchor"), F.lit(n_a)).cast("int"))
    r = rows.withColumn("y", F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(n_r)).cast("int"))
    a, r = a.withColumn("y", strips(n_r)), r.withColumn("x", strips(n_a))
    return a.groupBy("x", "y").cogroup(r.groupBy("x", "y"))


def _scores(left: pa.Table, right: pa.Table):
    """Tiles of scores between the anchors and the rows of a cell: (places of the anchors,
    places of the rows, scores). Rows come by ascending id."""
    dims_l = left.column("dims").to_numpy()
    dims_r = right.column("dims").to_numpy()
    ids = right.column("vec_id").to_numpy()
    for dims in np.intersect1d(dims_l, dims_r).tolist():
        at_l = np.flatnonzero(dims_l == dims)
        at_r = np.flatnonzero(dims_r == dims)
        at_r = at_r[np.argsort(ids[at_r], kind="stable")]
        step = 4096
        for k in range(0, len(at_r), step):
            some = at_r[k : k + step]
            b = _matrix(right.column("vec").take(pa.array(some)), dims)
            lines = max(1, TILE // len(some))
            for m in range(0, len(at_l), lines):
                rows = at_l[m : m + lines]
                a = _matrix(left.column("vec").take(pa.array(rows)), dims)
                yield rows, some, products(a, b, primes_for(dims, _bound(a, b)))


def _best(score: np.ndarray, allowed: np.ndarray, n: int) -> list[np.ndarray]:
    """For each line the places of its n best allowed scores; ties go to the first."""
    score = np.where(allowed, score, np.iinfo(np.int64).min)
    if score.shape[1] > n:
        least = np.partition(score, -n, axis=1)[:, -n]
    else:
        least = np.full(len(score), np.iinfo(np.int64).min)
    found = []
    near = allowed & (score >= least[:, None])
    for line in range(len(score)):
        at = np.flatnonzero(near[line])
        found.append(at[np.argsort(-score[line, at], kind="stable")][:n])
    return found


# -- mining ----------------------------------------------------------------------------
def mine(
    anchors: DataFrame,
    rows: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 5,
    window: Window_ = Window_(),
    id_: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    spark = rows.sparkSession
    rows = runtime.materialize(packed(rows, id_, label, vector, scale), "vectors")
    wanted = packed(anchors, id_, label, vector, scale)
    # A number for each anchor, so that several anchors of one id stay apart.
    wanted = runtime.materialize(
        wanted.withColumn("anchor", F.monotonically_increasing_id()), "anchors"
    )
    n_rows, row_bytes = rows.agg(F.count("*"), F.avg(F.length("vec") + 24)).first()
    least = max(spark.sparkContext.defaultParallelism, 1)
    n_a, n_r = grid(wanted.count(), n_rows, float(row_bytes or 0), least)

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of each anchor's own label in a cell."""
        out: list[tuple] = []
        a_id, a_label, a_no = (left.column(c).to_numpy() for c in ("vec_id", "label", "anchor"))
        r_id, r_label = (right.column(c).to_numpy() for c in ("vec_id", "label"))
        for lines, some, score in _scores(left, right):
            allowed = a_label[lines][:, None] == r_label[some][None, :]
            allowed &= a_id[lines][:, None] != r_id[some][None, :]
            for line, at in enumerate(_best(score, allowed, n_positives)):
                no = int(a_no[lines[line]])
                out += [(no, int(r_id[some[j]]), int(score[line, j])) for j in at.tolist()]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "positive_id", "positive_score"])

    schema = "anchor long, positive_id long, positive_score long"
    near = _cells(wanted, rows, n_a, n_r).applyInArrow(first, schema)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n_positives)
    positives = best.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives")
    )  # n_positives at most
    positives = runtime.materialize(positives, "positives")

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of other labels in the window of each positive, in a cell."""
        out: list[tuple] = []
        a_id, a_label, a_no = (left.column(c).to_numpy() for c in ("vec_id", "label", "anchor"))
        r_id, r_label = (right.column(c).to_numpy() for c in ("vec_id", "label"))
        known = left.column("positives").to_pylist()
        for lines, some, score in _scores(left, right):
            allowed = a_label[lines][:, None] != r_label[some][None, :]
            allowed &= a_id[lines][:, None] != r_id[some][None, :]
            for line, k in enumerate(lines.tolist()):
                spans = [
                    (-(-window.low * p["positive_score"] // 100), window.high * p["positive_score"] // 100)
                    for p in known[k]
                ]
                low, high = min(s[0] for s in spans), max(s[1] for s in spans)
                s = score[line]
                at = np.flatnonzero(allowed[line] & (s >= low) & (s <= high))
                at = at[np.argsort(-s[at], kind="stable")]
                falling = -s[at]
                for p, (low, high) in zip(known[k], spans, strict=True):
                    begin = int(np.searchsorted(falling, -high))
                    end = int(np.searchsorted(falling, -low, side="right"))
                    for j in at[begin : min(end, begin + n_negatives)].tolist():
                        out.append((int(a_no[k]), p["place"], int(r_id[some[j]]), int(s[j])))
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["anchor", "place", "negative_id", "negative_score"],
        )

    schema = "anchor long, place int, negative_id long, negative_score long"
    asked = wanted.join(positives, "anchor")
    found = _cells(asked, rows, n_a, n_r).applyInArrow(second, schema)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    named = asked.select(
        "anchor", F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p")
    ).select("anchor", "anchor_id", "p.*")
    return ranked.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

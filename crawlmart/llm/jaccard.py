"""Grouped prefix join: documents whose sets of word shingles have a Jaccard similarity of a
threshold or more, and the components of those links.

A set is ordered by how rare its shingles are. Two linked sets share a shingle among the
first n - ceil(t n) + 1 of theirs, their prefixes. Documents with equal prefix and size are
one group; groups that share a prefix shingle and pass the filters on size and position are
candidates; their members, the different sets of a group, are compared in full.

Exact and near copies can be many, so candidates are never all pairs of a run of groups with
one shingle. A short run gives all its pairs. A long run first gives links to its two most
central groups and to random neighbours. When those are verified and joined to components,
only pairs between different components of a run are left, and these are all verified;
a run of very many sets is compared by pairs of blocks, each in a place of its own.

The order of rarity comes from a table of counts of fixed size; it decides how many
candidates there are, never which links are found. Sets are known by 64-bit hashes, shingles
by 48 bits of theirs.

Defined results: null and blank texts have an empty set and link with nothing; equal rows link
with each other; a component's id is its smallest non-null doc_id; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm import hashing
from crawlmart.llm.common import added_up, shelved, small_batches
from crawlmart.llm.graph import components

SKETCH = 1 << 21  # counters of the order of rarity
PART = 1 << 15  # counters that travel together
LOT = 1 << 19  # bytes of text that are hashed together
WAITING = 1 << 19  # shingles that are counted together
BUCKET = 1 << 19  # prefix shingles in one bucket, about
SMALL = 8  # a run of so many groups gives all its pairs
STEP = 1 << 20  # pairs that are compared at once
BITS = 1 << 24  # of the filter on sets that take part in a candidate
CLASSES = 512  # of shingles, counted for each set that takes part in a candidate
SEEN = 500_000  # sets that a task remembers, so as not to send them again
LOW48 = np.uint64((1 << 48) - 1)


@dataclass(frozen=True)
class Join:
    words: int = 5  # of a shingle
    num: int = 75  # linked when den * intersection >= num * union
    den: int = 100
    block: int = 1 << 11  # sets of a run that one task compares with as many others

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, total):
        """Shingles that two sets with so many in all must share."""
        return -(-self.num * total // (self.num + self.den))


# -- shingles --------------------------------------------------------------------------
def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of each text, as they occur, in order of the rows."""
    salt = hashing.scramble(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    last, parts = -1, []

    def done() -> np.ndarray:
        w = parts[0] if len(parts) == 1 else np.concatenate(parts)
        k = min(words, len(w))
        if not k:
            return w
        n = len(w) - k + 1
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total += w[i : i + n] * salt[i]
        return hashing.scramble(total)

    for first, n, data, rows in hashing.lots(texts, LOT):
        data = hashing.lowered(data)
        starts, ends = hashing.word_bounds(data, rows)
        hashed = hashing.word_hashes(data, starts, ends)
        cuts = np.searchsorted(starts, np.append(rows, len(data)))
        for k in range(n):
            if first + k != last and last >= 0:
                yield done()
                parts = []
            last = first + k
            parts.append(hashed[cuts[k] : cuts[k + 1]])
    if last >= 0:
        yield done()


def rarity(docs: DataFrame, join: Join) -> tuple[np.ndarray, int]:
    """(a class for each of SKETCH counters, larger for more frequent shingles; the number of
    shingles). SKETCH bytes come to the driver, whatever the size of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, waiting, n = np.zeros(SKETCH, np.int64), [], 0
        for batch in batches:
            for found in shingle_sets(batch.column("text").fill_null(""), join.words):
                waiting.append((found % np.uint64(SKETCH)).astype(np.int64))
                n += len(found)
                if n > WAITING:
                    seen += np.bincount(np.concatenate(waiting), minlength=SKETCH)
                    waiting, n = [], 0
        if n:
            seen += np.bincount(np.concatenate(waiting), minlength=SKETCH)
        if seen.any():
            small = np.minimum(seen, 65535).astype("<u2")
            parts = [small[i : i + PART].tobytes() for i in range(0, SKETCH, PART)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array(parts, pa.binary()),
                    pa.array([int(seen[i : i + PART].sum()) for i in range(0, SKETCH, PART)]),
                ],
                ["part", "counts", "n"],
            )

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(PART, np.int64)
        for raw in rows.column("counts"):
            raw = raw.as_py()  # of a task, or a sum of some
            total += np.frombuffer(raw, "<u2" if len(raw) == 2 * PART else "<i8")
        size = pa.array([sum(rows.column("n").to_pylist())], pa.int64())
        return pa.table(
            [rows.column("part").slice(0, 1), pa.array([total.astype("<i8").tobytes()], pa.binary()), size],
            ["part", "counts", "n"],
        )

    def squeeze(rows: pa.Table) -> pa.Table:
        raw = [classes(np.frombuffer(x.as_py(), "<i8")).tobytes() for x in rows.column("counts")]
        return rows.set_column(1, "counts", pa.array(raw, pa.binary()))

    schema = "part int, counts binary, n long"
    counted = docs.select("text").mapInArrow(count, schema)
    out, n = np.zeros(SKETCH, np.uint8), 0
    for row in added_up(counted, "part", add, schema, squeeze).collect():
        at = row["part"] * PART
        out[at : at + PART] = np.frombuffer(row["counts"], np.uint8)
        n += row["n"]
    return out, n


def classes(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts + 1.0) * 8, 255).astype(np.uint8)


class _Sets:
    """What the passes over the texts need of one set."""

    def __init__(self, found: np.ndarray, rare: np.ndarray, join: Join):
        self.hashes = np.unique(found)
        self.n = len(self.hashes)
        klass = rare[(self.hashes % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64)
        key = klass << np.uint64(56) | self.hashes >> np.uint64(8)
        size = join.prefix(self.n) if self.n else 0
        self.prefix = self.hashes[np.argsort(key, kind="stable")[:size]]

    @property
    def id(self) -> int:
        return _signed(self.hashes, self.n)

    @property
    def group(self) -> int:
        return _signed(self.prefix, self.n)


def _signed(hashes: np.ndarray, n: int) -> int:
    total = np.add.reduce(hashing.scramble(hashes ^ np.uint64(n)), dtype=np.uint64)
    return int(hashing.scramble(np.array([total + np.uint64(n)], np.uint64)).view(np.int64)[0])


# -- passes over the texts -------------------------------------------------------------
def memberships(docs: DataFrame, rare: Broadcast, join: Join) -> DataFrame:
    """doc_id, n (size of the set), c (the set) and g (its group) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, c, g = [], [], []
            for found in shingle_sets(batch.column("text").fill_null(""), join.words):
                s = _Sets(found, rare.value, join)
                n.append(s.n)
                c.append(s.id)
                g.append(s.group)
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, c, g))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "c", "g"])

    schema = f"doc_id {kind}, n long, c long, g long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def prefix_index(docs: DataFrame, rare: Broadcast, n_buckets: int, join: Join) -> DataFrame:
    """Prefix shingles of the groups, dealt over buckets: each row holds those of one lot of
    groups that fall into one bucket, as arrays (shingle, place in the prefix, group's place
    in the lot) and the lot's groups with their sizes."""

    def rows(lot: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(p) for _, _, p in lot]
        token = np.concatenate([p for _, _, p in lot])
        item = np.repeat(np.arange(len(lot)), sizes)
        place = np.concatenate([np.arange(k) for k in sizes])
        bucket = (token >> np.uint64(16)) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        group = np.array([g for g, _, _ in lot], np.int64)
        size = np.array([n for _, n, _ in lot], np.int64)
        out: list[list] = [[] for _ in range(6)]
        for at in np.split(order, cuts):
            used, local = np.unique(item[at], return_inverse=True)
            t = token[at] & LOW48
            for column, value in zip(
                out,
                (
                    int(bucket[at[0]]),
                    t.astype("<u4").tobytes() + (t >> np.uint64(32)).astype("<u2").tobytes(),
                    np.minimum(place[at], 65535).astype("<u2").tobytes(),
                    local.astype("<u2").tobytes(),
                    group[used].astype("<i8").tobytes(),
                    size[used].astype("<u4").tobytes(),
                ),
                strict=True,
            ):
                column.append(value)
        kinds = [pa.int32()] + [pa.binary()] * 5
        arrays = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, waiting, seen = [], 0, set()
        for batch in batches:
            for found in shingle_sets(batch.column("text").fill_null(""), join.words):
                if not len(found):
                    continue
                s = _Sets(found, rare.value, join)
                g = s.group
                if g in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(g)
                lot.append((g, s.n, s.prefix))
                waiting += len(s.prefix)
                if waiting >= BUCKET or len(lot) >= 60_000:
                    yield rows(lot)
                    lot, waiting = [], 0
        if lot:
            yield rows(lot)

    schema = "bucket int, token binary, place binary, item binary, grp binary, size binary"
    return docs.select("text").mapInArrow(run, schema)


INDEX = ["bucket", "token", "place", "item", "grp", "size"]


def taking_part(docs: DataFrame, filter_: Broadcast, join: Join) -> DataFrame:
    """c, n, the shingles (48 bits each, ascending) and the number of shingles in each of
    CLASSES classes (a byte each, 255 for more) of the sets that the filter lets through: all
    that take part in a candidate, and few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = filter_.value, set()
        for batch in batches:
            c, n, raw, counts = [], [], [], []
            for found in shingle_sets(batch.column("text").fill_null(""), join.words):
                hashes = np.unique(found)
                if not len(hashes):
                    continue
                known = _signed(hashes, len(hashes))
                at = known % BITS
                if not bits[at >> 3] >> (at & 7) & 1 or known in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(known)
                c.append(known)
                n.append(len(hashes))
                raw.append(_packed(np.unique(hashes & LOW48)))
                of = (hashes >> np.uint64(20)) % np.uint64(CLASSES)
                count = np.bincount(of.astype(np.int64), minlength=CLASSES)
                counts.append(np.minimum(count, 255).astype(np.uint8).tobytes())
            columns = [pa.array(x, pa.int64()) for x in (c, n)]
            columns += [pa.array(x, pa.binary()) for x in (raw, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["c", "n", "shingles", "counts"])

    schema = "c long, n long, shingles binary, counts binary"
    sent = docs.select("text").mapInArrow(run, schema)
    return sent.groupBy("c").agg(*[F.first(x).alias(x) for x in ("n", "shingles", "counts")])


def _packed(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes() + (x >> np.uint64(32)).astype("<u2").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    low = np.frombuffer(raw, "<u4", n).astype(np.uint64)
    return low | np.frombuffer(raw, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)


# -- candidates ------------------------------------------------------------------------
def _near(na, nb, ia, ib, join: Join):
    """The filters on size and on the places of a shared shingle."""
    fits = join.den * np.minimum(na, nb) >= join.num * np.maximum(na, nb)
    at_most = np.minimum(na - ia, nb - ib)  # shared from here on
    return fits & (at_most >= join.overlap(na + nb))


def candidates(index: DataFrame, join: Join) -> DataFrame:
    """kind 0: pairs of groups (a, b); kind 1: shingle a of a long run with group b, in whose
    prefix it has this place."""

    def run(table: pa.Table) -> pa.Table:
        tokens, places, groups, sizes = [], [], [], []
        for t, p, i, g, s in zip(*(table.column(x) for x in INDEX[1:]), strict=True):
            item = np.frombuffer(i.as_py(), "<u2")
            tokens.append(_unpacked(t.as_py()))
            places.append(np.frombuffer(p.as_py(), "<u2").astype(np.int64))
            groups.append(np.frombuffer(g.as_py(), "<i8")[item])
            sizes.append(np.frombuffer(s.as_py(), "<u4").astype(np.int64)[item])
        token, place = np.concatenate(tokens), np.concatenate(places)
        group, size = np.concatenate(groups), np.concatenate(sizes)
        order = np.lexsort((group, token))
        token, place, group, size = (x[order] for x in (token, place, group, size))
        new = np.append(True, (token[1:] != token[:-1]) | (group[1:] != group[:-1]))
        token, place, group, size = (x[new] for x in (token, place, group, size))
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        length = np.diff(np.append(first, len(token)))
        run_size = np.repeat(length, length)
        a, b = [], []

        def keep(i: np.ndarray, j: np.ndarray) -> None:
            ok = _near(size[i], size[j], place[i], place[j], join)
            x, y = group[i[ok]], group[j[ok]]
            a.append(np.minimum(x, y))
            b.append(np.maximum(x, y))

        short = np.flatnonzero((run_size > 1) & (run_size <= SMALL))
        for step in range(1, SMALL):
            i = short[short + step < len(token)]
            i = i[token[i] == token[i + step]]
            keep(i, i + step)
        runs = []
        for at, n in zip(first[length > SMALL], length[length > SMALL], strict=True):
            members = np.arange(at, at + n)
            for leader in members[np.lexsort((group[members], place[members]))[:2]]:
                keep(members[members != leader], np.full(n - 1, leader))
            mixed = hashing.scramble(group[members].view(np.uint64) ^ token[at])
            members = members[np.argsort(mixed, kind="stable")]
            keep(members[:-1], members[1:])
            runs.append(members)
        x = np.concatenate(a) if a else np.zeros(0, np.int64)
        y = np.concatenate(b) if b else np.zeros(0, np.int64)
        x, y = _unique_pairs(x, y)
        long = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        kind = np.append(np.zeros(len(x), np.int32), np.ones(len(long), np.int32))
        return pa.table(
            [
                pa.array(kind, pa.int32()),
                pa.array(np.append(x, token[long].view(np.int64)), pa.int64()),
                pa.array(np.append(y, group[long]), pa.int64()),
                pa.array(np.append(np.zeros(len(x), np.int64), place[long]), pa.int64()),
            ],
            ["kind", "a", "b", "place"],
        )

    return index.groupBy("bucket").applyInArrow(run, "kind int, a long, b long, place long")


def _unique_pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]
    return x[new], y[new]


def cross_pairs(runs: DataFrame, n_buckets: int, join: Join) -> DataFrame:
    """Pairs (a, b) of sets of one run that lie in different components.

    ``runs``: run, c, n, place, root. Of a run inside one component, and of sets that could not
    even be linked with the smallest set of their run, nothing is moved. A run of up to
    ``join.block`` sets is compared in one place. A longer one is cut into blocks of sets of like
    sizes, and pairs of blocks that may hold a link are compared apart from each other, so no
    task holds more than two blocks of a run.
    """
    runs = runtime.materialize(runs, "runs")
    mixed = runs.groupBy("run").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.min("n").alias("least"),
        F.count(F.lit(1)).alias("k"),
    )
    # Written, so that the join knows its size, and deals out a hot run if it is not small.
    mixed = runtime.materialize(mixed.filter("low < high").select("run", "least", "k"), "mixed")
    left = runs.join(mixed, "run")
    other = F.greatest("least", _at_least(F.col("n") * join.num, join.den))
    left = left.filter(F.col("n") - F.col("place") >= _overlap(F.col("n") + other, join))
    columns = ["c", "n", "place", "root"]

    def inside(table: pa.Table) -> pa.Table:
        names = ("run", "root", "c", "n", "place")
        token, root, c, n, place = (table.column(x).to_numpy() for x in names)
        order = np.lexsort((c, root, token))
        token, root, c, n, place = (x[order] for x in (token, root, c, n, place))
        found = _Pairs()
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
        for low, high in zip(starts, np.append(starts[1:], len(token)), strict=True):
            roots = low + np.flatnonzero(np.append(True, root[low + 1 : high] != root[low : high - 1]))
            for x, y in zip(roots[:-1], roots[1:], strict=True):  # a root against all that follow
                found.compare(np.arange(x, y), np.arange(y, high), (c, n, place, root), join)
        return found.table()

    def across(table: pa.Table) -> pa.Table:
        sets = tuple(table.column(x).to_numpy() for x in columns)
        side = table.column("side").to_numpy()
        found = _Pairs()
        one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        found.compare(one, two, sets, join)
        return found.table()

    short = left.filter(F.col("k") <= join.block).drop("k", "least")
    short = short.withColumn("bucket", F.pmod(F.xxhash64("run"), F.lit(n_buckets)))
    pairs = short.groupBy("bucket").applyInArrow(inside, "a long, b long")
    if not mixed.filter(F.col("k") > join.block).isEmpty():
        long = left.filter(F.col("k") > join.block).drop("k", "least")
        cells = _cells(long, join)
        pairs = pairs.unionByName(
            cells.groupBy("run", "x", "y").applyInArrow(across, "a long, b long")
        )
    return pairs.distinct()


def _cells(long: DataFrame, join: Join) -> DataFrame:
    """The rows of ``long`` once for each pair of blocks (x, y) of their run that their block
    belongs to: side 0 for the rows of x, 1 for those of y, 2 where x is y.

    Sizes of one band differ by less than a link allows, so most pairs of blocks of far bands
    are barred by the bounds of their sizes. Blocks are known by a number per run that follows
    from counts, not from the order of rows."""
    ratio = max(join.den / join.num, 1.05)  # bands only make the bounds narrow
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(ratio)).cast("int")
    long = long.withColumn("band", band)
    parts = long.groupBy("run", "band").agg(_at_least(F.count(F.lit(1)), join.block).alias("parts"))
    part = F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")
    long = long.join(runtime.materialize(parts, "parts"), ["run", "band"])
    long = long.withColumn("block", F.shiftleft(F.col("band").cast("long"), 32) + part)
    long = runtime.materialize(long.drop("band", "parts"), "blocks")
    room = F.col("n") - F.col("place")
    bounds = long.groupBy("run", "block").agg(
        F.min("n").alias("n0"),
        F.max("n").alias("n1"),
        F.max(room).alias("room"),
        F.min("root").alias("r0"),
        F.max("root").alias("r1"),
    )
    bounds = runtime.materialize(bounds, "bounds")
    x = bounds.select("run", *[F.col(c).alias(f"x_{c}") for c in bounds.columns[1:]])
    y = bounds.select("run", *[F.col(c).alias(f"y_{c}") for c in bounds.columns[1:]])
    may = (
        (F.col("x_block") <= F.col("y_block"))
        & (F.col("x_n1") * join.den >= F.col("y_n0") * join.num)
        & (F.col("y_n1") * join.den >= F.col("x_n0") * join.num)
        & (F.least("x_room", "y_room") >= _overlap(F.col("x_n0") + F.col("y_n0"), join))
        & (F.least("x_r0", "y_r0") < F.greatest("x_r1", "y_r1"))
    )
    blocks = (F.col("x_block").alias("x"), F.col("y_block").alias("y"))
    met = x.join(y, "run").filter(may).select("run", *blocks)
    one, two, both = (
        F.struct(F.col(name).alias("block"), F.lit(side).alias("side"))
        for name, side in (("x", 0), ("y", 1), ("x", 2))
    )
    sides = F.when(F.col("x") == F.col("y"), F.array(both)).otherwise(F.array(one, two))
    met = runtime.materialize(met.select("run", "x", "y", F.inline(sides)), "cells")
    return long.join(met, ["run", "block"]).select("run", "x", "y", "side", "c", "n", "place", "root")


def _at_least(total: Column, by: int) -> Column:
    """total / by, rounded up, in whole numbers."""
    return F.floor((total + (by - 1)) / by)


def _overlap(total: Column, join: Join) -> Column:
    return _at_least(total * join.num, join.num + join.den)


class _Pairs:
    """Different pairs of sets that may be linked, gathered step by step."""

    def __init__(self):
        self.a, self.b, self.new, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def compare(self, one: np.ndarray, two: np.ndarray, sets: tuple, join: Join) -> None:
        """Rows ``one`` against rows ``two`` of (c, n, place, root), STEP pairs at a time."""
        c, n, place, root = sets
        step = max(1, STEP // max(1, len(two)))
        for z in range(0, len(one), step):
            i = np.repeat(one[z : z + step], len(two))
            j = np.tile(two, len(one[z : z + step]))
            ok = (root[i] != root[j]) & _near(n[i], n[j], place[i], place[j], join)
            p, q = c[i[ok]], c[j[ok]]
            self.new.append((np.minimum(p, q), np.maximum(p, q)))
            self.waiting += len(p)
            if self.waiting > max(STEP, len(self.a)):  # sorted when they have doubled
                self.settle()

    def settle(self) -> None:
        a, b = (np.concatenate([x, *y]) for x, y in zip((self.a, self.b), zip(*self.new), strict=True))
        (self.a, self.b), self.new, self.waiting = _unique_pairs(a, b), [], 0

    def table(self) -> pa.Table:
        if self.new:
            self.settle()
        return pa.table([pa.array(self.a, pa.int64()), pa.array(self.b, pa.int64())], ["a", "b"])


# -- verification ----------------------------------------------------------------------
def verified(pairs: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """The pairs of sets (a, b) that are linked, compared in full.

    First by the numbers of shingles in each class: the smaller ones add up to no less than
    what two sets share. Only pairs that this leaves move with their shingles."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(pairs))
    sets = runtime.materialize(taking_part(docs, bits, join), "sets")

    def both(pairs: DataFrame, what: str) -> DataFrame:
        for x in ("a", "b"):
            own = sets.select(
                F.col("c").alias(x), F.col("n").alias("n" + x), F.col(what).alias("s" + x)
            )
            pairs = pairs.join(own, x)
        return pairs.select("a", "b", "na", "nb", "sa", "sb")

    def kept(batch: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
        ids = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
        return ids.filter(pa.array(keep, pa.bool_()))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            x, y = (_matrix(batch.column(s)) for s in ("sa", "sb"))
            least = np.minimum(x, y)
            shared = np.where((least == 255).any(axis=1), na, least.sum(axis=1, dtype=np.int64))
            yield kept(batch, shared >= join.overlap(na + nb))

    def certain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(x) for x in ("na", "nb", "sa", "sb"))
            for na, nb, sa, sb in zip(*columns, strict=True):
                merged = np.concatenate((_unpacked(sa.as_py()), _unpacked(sb.as_py())))
                merged.sort(kind="stable")
                same = int(np.count_nonzero(merged[1:] == merged[:-1]))
                keep.append(same >= join.overlap(na.as_py() + nb.as_py()))
            yield kept(batch, np.array(keep, bool))

    schema = "a long, b long"
    left = runtime.materialize(both(pairs, "counts").mapInArrow(possible, schema), "possible")
    return both(left, "shingles").mapInArrow(certain, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of byte strings of one length, a row each."""
    raw = b"".join(x.as_py() for x in column)
    return np.frombuffer(raw, np.uint8).reshape(len(column), -1 if raw else 0)


def _filter_of(pairs: DataFrame) -> bytes:
    """A bit for each set of the pairs; BITS bits come to the driver, whatever the input."""
    c = pairs.select(F.explode(F.array("a", "b")).alias("c"))
    at = F.pmod("c", F.lit(BITS))
    words = c.select((at / 32).cast("long").alias("word"), (at % 32).cast("int").alias("bit"))
    masks = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    out = np.zeros(BITS // 32, "<u4")
    got = masks.toArrow()
    out[got["word"].to_numpy()] = got["mask"].to_numpy()
    return out.tobytes()


# -- the join --------------------------------------------------------------------------
def linked_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    table, n_shingles = rarity(docs, join)
    rare = spark.sparkContext.broadcast(table)
    members = runtime.materialize(memberships(docs, rare, join), "members")
    n_buckets = max(1, -(-n_shingles * join.prefix(join.den) // join.den // BUCKET))
    found = candidates(prefix_index(docs, rare, n_buckets, join), join)
    found = runtime.materialize(found, "candidates")
    groups = runtime.materialize(
        members.filter("n > 0").groupBy("g", "c").agg(F.first("n").alias("n")), "groups"
    )
    leaders = groups.groupBy("g").agg(F.min("c").alias("leader"), F.count(F.lit(1)).alias("k"))
    leaders = runtime.materialize(leaders, "leaders")
    of_groups = found.filter("kind = 0").select("a", "b").distinct()
    left = leaders.select(F.col("g").alias("a"), F.col("leader").alias("x"), F.col("k").alias("ka"))
    right = leaders.select(F.col("g").alias("b"), F.col("leader").alias("y"), F.col("k").alias("kb"))
    pairs = runtime.materialize(of_groups.join(left, "a").join(right, "b"), "pairs")
    several = leaders.filter("k > 1").select("g", "leader")
    stars = groups.join(several, "g").filter("c <> leader")
    first = pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(
        stars.select(F.col("leader").alias("a"), F.col("c").alias("b"))
    )
    links = verified(first.distinct(), docs, join)
    roots = components(links)
    # Whatever a first round cannot settle: long runs, groups of several sets, and pairs with
    # such a group.
    runs = found.filter("kind = 1").select(F.xxhash64("a").alias("run"), F.col("b").alias("g"), "place")
    wide = pairs.filter("ka > 1 or kb > 1").withColumn("run", F.xxhash64("a", "b"))
    whole = F.lit(0).cast("long").alias("place")
    runs = (
        runs.unionByName(wide.select("run", F.explode(F.array("a", "b")).alias("g"), whole))
        .unionByName(several.select(F.xxhash64("g", F.lit(1)).alias("run"), "g", whole))
        .join(groups, "g")
        .join(roots.withColumnRenamed("node", "c"), "c", "left")
        .select("run", "c", "n", "place", F.coalesce("root", "c").alias("root"))
    )
    rest = runtime.materialize(cross_pairs(runs, n_buckets, join), "rest")
    if not rest.isEmpty():
        more = verified(rest, docs, join)
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.unionByName(more))
    return _labelled(members, roots)


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    sets = members.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("least"))
    sets = sets.join(roots.withColumnRenamed("node", "c"), "c", "left")
    sets = sets.withColumn("root", F.coalesce("root", "c"))
    named = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    sets = sets.join(named, "root").select("c", "component_id")
    none = members.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    some = members.filter("n > 0").join(sets, "c")
    return some.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(none)


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id (null
    first), of equal ids the one with the smallest hash of its row. Equal rows count once.

    Texts are shuffled once, by the hash of the row."""
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    hashed, names = shelved(docs)
    hashed = hashed.withColumn("hash", F.xxhash64(*[names[c] for c in plain]))
    ids = F.struct(F.col(names["doc_id"]).alias("id"), "hash")
    rows = hashed.select(ids.alias("doc_id"), F.col(names["text"]).alias("text"))
    found = linked_components(rows, join)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id.hash")
    kept = hashed.join(first.distinct(), "hash", "left_semi")
    kept = kept.groupBy("hash").agg(*[F.first(c).alias(c) for c in names.values()])
    return kept.select(*[F.col(names[c]).alias(c) for c in docs.columns])

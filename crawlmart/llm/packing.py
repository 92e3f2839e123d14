"""Best-fit packing of tokenized documents by a linear grouping scheme.

Only lengths decide where a piece goes, and there are at most ``capacity`` of them. So the
plan is made from the number of pieces of each length, whatever the size of the corpus:
large lengths are rounded up within groups of equal cardinality, configurations of the
rounded sizes are chosen, actual lengths take the places of rounded ones, and small lengths
are put where they fit best. Pieces then find their places by their rank in their length.

Defined results: null and empty texts have the end token alone; equal rows are packed each;
an empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm import hashing
from crawlmart.llm.common import running, small_batches

END = 0  # the token behind each document
KNOWN = 700_000  # words that a worker keeps at most; it then begins anew
CELL = 4096  # pieces that one task orders together
CHUNK = 1024  # ranks for which places are looked up together


@dataclass(frozen=True)
class Pack:
    capacity: int = 2048
    small: int = 256  # lengths up to this are put where they fit best
    groups: int = 512  # of equal cardinality, of the larger lengths


# -- tokens ----------------------------------------------------------------------------
class _Tokens:
    """Token ids of texts by a tokenizer whose words are independent of each other.

    The vocabulary lower-cases, drops white space and never merges across it, nor from a
    letter to ASCII punctuation. So each different piece between such borders is encoded
    once by the tokenizer and remembered under a 64-bit hash. Texts that could hold a
    special token go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[int, int] = {}
        self.start = np.zeros(1, np.int64)  # of each known word in ids, and the end
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        if len(self.place) + len(words) > KNOWN:
            self._forget()
        got = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        first = len(self.start) - 1
        self.place.update(zip(hashes, range(first, first + len(hashes)), strict=True))
        ends = self.start[-1] + np.cumsum([len(x) for x in got], dtype=np.int64)
        self.start = np.concatenate((self.start, ends))
        flat = np.fromiter((i for x in got for i in x), np.uint32)
        self.ids = np.concatenate((self.ids, flat))

    def of_lot(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a lot, and the number of ids of each row."""
        data = hashing.lowered(data)
        letter = (data >= 97) & (data <= 122)
        mark = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57))
        breaks = mark & np.concatenate(([False], letter[:-1])) if len(data) else mark
        starts, ends = hashing.word_bounds(data, rows, breaks)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(rows), np.int64)
        codes, different = pd.factorize(hashing.word_hashes(data, starts, ends))
        at = [self.place.get(h, -1) for h in different.tolist()]
        if -1 in at:
            _, first = np.unique(codes, return_index=True)
            new = [i for i, x in enumerate(at) if x < 0]
            words = [
                data[starts[first[i]] : ends[first[i]]].tobytes().decode("utf-8") for i in new
            ]
            before = len(self.place)
            self._learn([int(different[i]) for i in new], words)
            if len(self.place) < before + len(new):  # the memory was cleared
                return self.of_lot(data, rows)
            at = [self.place[h] for h in different.tolist()]
        word = np.asarray(at, np.int64)[codes]
        size = self.start[word + 1] - self.start[word]
        stop = np.cumsum(size)
        index = np.arange(int(stop[-1])) + np.repeat(self.start[word] - (stop - size), size)
        upto = np.concatenate(([0], stop))[np.searchsorted(starts, np.append(rows, len(data)))]
        return self.ids[index], np.diff(upto)

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, without the end token; in order."""
        parts: list[np.ndarray] = []
        last = -1
        for first, n, data, rows in hashing.lots(texts):
            if b"<|" in data.tobytes():
                ids = [self._row_ids(data, rows, k) for k in range(n)]
            else:
                flat, sizes = self.of_lot(data, rows)
                ids = np.split(flat, np.cumsum(sizes)[:-1])
            for k in range(n):
                if first + k != last and last >= 0:
                    yield np.concatenate(parts) if len(parts) > 1 else parts[0]
                    parts = []
                last = first + k
                parts.append(ids[k])
        if last >= 0:
            yield np.concatenate(parts) if len(parts) > 1 else parts[0]

    def _row_ids(self, data: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        end = rows[k + 1] if k + 1 < len(rows) else len(data)
        text = data[rows[k] : end].tobytes().decode("utf-8")
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(found, np.uint32)


_loaded: dict[str, _Tokens] = {}


def _tokens(path: str) -> _Tokens:
    """One per worker process: what it has learnt serves the tasks that follow."""
    if path not in _loaded:
        _loaded[path] = _Tokens(path)
    return _loaded[path]


PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, pack: Pack = Pack(), ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each document, and with
    ``ids`` the token ids, little-endian in 32 bits each."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {PIECE}" + ", ids binary" * ids
    size = pack.capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            row, piece, start, length, crc, raw = [], [], [], [], [], []
            for k, found in enumerate(tokens.of_texts(texts)):
                whole = np.append(found, END).astype("<u4")
                for p, low in enumerate(range(0, len(whole), size)):
                    part = whole[low : low + size].tobytes()
                    row.append(k)
                    piece.append(p)
                    start.append(low)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        raw.append(part)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


# -- the plan --------------------------------------------------------------------------
class Place(NamedTuple):
    """Pieces of one length with ranks from ``first`` on: ``each`` of them in one sequence
    behind the other from ``offset`` on, the next ones in the next sequence."""

    length: int
    first: int
    n: int
    sequence: int
    each: int
    offset: int


class _Group:
    """Lengths that count as the largest of them; taken longest first."""

    def __init__(self) -> None:
        self.runs: list[list[int]] = []  # length, first rank, how many
        self.left = self.size = 0

    def add(self, length: int, first: int, n: int) -> None:
        self.size = max(self.size, length)
        self.runs.append([length, first, n])
        self.left += n

    def take(self, n: int) -> list[tuple[int, int, int]]:
        self.left -= n
        out = []
        while n:
            run = self.runs[0]
            k = min(n, run[2])
            out.append((run[0], run[1], k))
            run[1] += k
            run[2] -= k
            n -= k
            if not run[2]:
                self.runs.pop(0)
        return out


def grouped(counts: dict[int, int], n_groups: int) -> list[_Group]:
    """Linear grouping: the pieces, longest first, in groups of equal cardinality."""
    total = sum(counts.values())
    most = -(-total // n_groups) if total else 1
    groups: list[_Group] = []
    room = 0
    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            if not room:
                groups.append(_Group())
                room = most
            k = min(left, room)
            groups[-1].add(length, first, k)
            first, left, room = first + k, left - k, room - k
    return groups


def configuration(groups: list[_Group], capacity: int) -> dict[int, int]:
    """The largest size left and, beside it, the sizes that fill a sequence best; among
    equally full ones, those with the larger sizes. Returns how often each group is used."""
    top = next(i for i, g in enumerate(groups) if g.left)
    room = capacity - groups[top].size
    mask = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for i in range(len(groups) - 1, top - 1, -1):  # smallest first
        group = groups[i]
        most = min(group.left - (i == top), room // group.size)
        if most <= 0:
            continue
        layers.append((i, most, reach))
        for _ in range(most):
            wider = (reach | reach << group.size) & mask
            if wider == reach:
                break
            reach = wider
    full, uses = reach.bit_length() - 1, defaultdict(int)
    uses[top] += 1
    for i, most, below in reversed(layers):
        size = groups[i].size
        for k in range(min(most, full // size), -1, -1):
            if below >> (full - k * size) & 1:
                break
        if k:
            uses[i] += k
            full -= k * size
    return dict(uses)


def solve(counts: dict[int, int], pack: Pack = Pack()) -> list[Place]:
    """Places for all pieces of a corpus with so many pieces of each length."""
    capacity, places, used = pack.capacity, [], 0
    if n := counts.get(capacity, 0):
        places.append(Place(capacity, 0, n, 0, 1, 0))
        used = n
    space: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space left: sequences
    large = {x: n for x, n in counts.items() if pack.small < x < capacity and n}
    groups = grouped(large, pack.groups)
    while any(g.left for g in groups):
        uses = configuration(groups, capacity)
        times = min(groups[i].left // k for i, k in uses.items())
        rows = [(used, times, 0)]  # sequence, how many alike, filled so far
        used += times
        for i in sorted(uses):
            for _ in range(uses[i]):
                rows = _substitute(rows, groups[i].take(times), places)
        for sequence, n, filled in rows:
            space[capacity - filled].append((sequence, n))
        groups = [g for g in groups if g.left]
    for length in sorted((x for x in counts if x <= pack.small and x < capacity), reverse=True):
        used = _best_fit(length, counts[length], space, places, used, capacity)
    return places


def _substitute(
    rows: list[tuple[int, int, int]], runs: list[tuple[int, int, int]], places: list[Place]
) -> list[tuple[int, int, int]]:
    """Puts actual lengths, one in each sequence, into sequences that are filled alike."""
    out, runs = [], list(reversed(runs))
    for sequence, n, filled in rows:
        while n:
            length, first, have = runs.pop()
            k = min(n, have)
            places.append(Place(length, first, k, sequence, 1, filled))
            out.append((sequence, k, filled + length))
            if have > k:
                runs.append((length, first + k, have - k))
            sequence, n = sequence + k, n - k
    return out


def _best_fit(
    length: int,
    n: int,
    space: dict[int, list[tuple[int, int]]],
    places: list[Place],
    used: int,
    capacity: int,
) -> int:
    """Puts pieces of one length where the least space is left; opens sequences at need."""
    first = 0
    while n:
        left = min((s for s, rows in space.items() if s >= length and rows), default=0)
        if left:
            sequence, have = space[left].pop()
        else:
            left, sequence, have = capacity, used, -(-n // (capacity // length))
            used += have
        each = left // length
        k = min(have, n // each)
        if k:
            places.append(Place(length, first, k * each, sequence, each, capacity - left))
            space[left - each * length].append((sequence, k))
            first, n = first + k * each, n - k * each
            sequence, have = sequence + k, have - k
        if have and n:  # fewer than fill one more sequence
            places.append(Place(length, first, n, sequence, n, capacity - left))
            space[left - n * length].append((sequence, 1))
            sequence, have, n = sequence + 1, have - 1, 0
        if have:
            space[left].append((sequence, have))
    return used


# -- the places of the pieces ----------------------------------------------------------
def pack_documents(
    docs: DataFrame, tokenizer: str, pack: Pack = Pack(), ids: bool = False
) -> DataFrame:
    """Pieces with sequence_id and offset. What comes to the driver is one count for each
    length, ``capacity`` at most."""
    small_batches(docs.sparkSession)
    cut = runtime.materialize(pieces(docs, tokenizer, pack, ids), "pieces")
    counts = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n_alike"))
    known = {r["length"]: r["n_alike"] for r in counts.collect()}
    spark = docs.sparkSession
    schema = "length long, first long, n long, sequence long, each long, offset long"
    plan = spark.createDataFrame([tuple(p) for p in solve(known, pack)], schema)
    alike = spark.createDataFrame(list(known.items()), "length long, n_alike long")
    order = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = cut.join(alike, "length").withColumn(
        "cell", F.pmod(F.xxhash64(*order), F.ceil(F.col("n_alike") / CELL))
    )
    ranked = running(
        ranked.withColumn("one", F.lit(1).cast("long")), ["length"], "cell", order, "one", "rank"
    )
    chunk = F.floor(F.col("rank") / CHUNK)
    last = F.col("first") + F.col("n") - 1
    chunks = F.sequence(F.floor(F.col("first") / CHUNK), F.floor(last / CHUNK))
    plan = plan.withColumn("chunk", F.explode(chunks))
    placed = ranked.withColumn("chunk", chunk).join(plan, ["length", "chunk"])
    placed = placed.filter((F.col("rank") >= F.col("first")) & (F.col("rank") <= last))
    turn = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(turn / F.col("each"))).alias("sequence_id"),
        (F.col("offset") + turn % F.col("each") * F.col("length")).alias("offset"),
        *["ids"] * ids,
    )

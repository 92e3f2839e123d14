"""Runs of repeated words: all maximal periodic stretches of a text, and the text without them.

Words are compared whole. A suffix tree of the words (Ukkonen) and one of their reversal give,
by the least depth on an Euler tour between two leaves, how far two places agree to the right
and to the left, in constant time each. Every run has a Lyndon root under an order of words
or under its reverse, and that root is the longest Lyndon word at its first place. So two
candidates per word (place, length of its longest Lyndon word), extended in both directions,
give all runs.

Only stretches of words that can hold a run reach the trees: in a run of period q and at least
``max(6, 4 q)`` words, every three neighbouring words occur three times or more. Stretches
without such a threefold sequence of three are cut away until nothing changes; this loses
no run, whatever the text.

Defined results: null and empty texts have no runs and an empty rest; repeated rows give a
row each; an empty table gives none. All columns of the input are kept (an own column of the
result takes the place of one with its name). A worker needs some 300 bytes for a word that
reaches the trees, 100 for any other, and holds a few MB of texts, or one longer text, at once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmart.llm.common import small_batches
from crawlmart.llm.hashing import scramble

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
GROUP = 1 << 18  # words that are looked through together
COARSE = 1 << 20  # counters of the first look
BLOCK = 32  # entries of a tour whose least are known one by one
CHUNK = 1 << 18  # candidates that are extended together


# -- suffix tree -----------------------------------------------------------------------
class Tree(NamedTuple):
    """Edges (parent * symbols + first symbol -> child), and for each node where its edge
    begins and ends and which suffix it is (-1: none)."""

    edges: dict[int, int]
    first: array
    last: array
    suffix: array


def ukkonen(s: list[int], symbols: int) -> Tree:
    """The suffix tree of a sequence whose last symbol occurs once."""
    n = len(s)
    edges: dict[int, int] = {}
    first, last, link, suffix = array("q", [0]), array("q", [0]), array("q", [0]), array("q", [-1])
    node = edge = length = left = 0  # where the next suffix ends, and how many are left
    for i in range(n):
        c = s[i]
        left += 1
        open_ = 0  # an inner node that has no link yet
        while left:
            if not length:
                edge = i
            key = node * symbols + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(first)
                first.append(i)
                last.append(n)
                link.append(0)
                suffix.append(i - left + 1)
                if open_:
                    link[open_] = node
                    open_ = 0
            else:
                start = first[child]
                if length:
                    size = last[child] - start
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                if s[start + length] == c:
                    if open_:
                        link[open_] = node
                    length += 1
                    break
                middle = len(first)
                edges[key] = middle
                first.append(start)
                last.append(start + length)
                link.append(0)
                suffix.append(-1)
                edges[middle * symbols + c] = middle + 1
                first.append(i)
                last.append(n)
                link.append(0)
                suffix.append(i - left + 1)
                first[child] = start + length
                edges[middle * symbols + s[start + length]] = child
                if open_:
                    link[open_] = middle
                open_ = middle
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return Tree(edges, first, last, suffix)


class Tour:
    """An Euler tour over a suffix tree, children in the order of their symbols."""

    def __init__(self, tree: Tree, n: int, symbols: int):
        keys = np.fromiter(tree.edges.keys(), np.int64, len(tree.edges))
        children = np.fromiter(tree.edges.values(), np.int64, len(tree.edges))
        order = np.argsort(keys)
        parents, children = keys[order] // symbols, children[order]
        size = np.frombuffer(tree.last, np.int64) - np.frombuffer(tree.first, np.int64)
        n_nodes = len(tree.first)
        begin = np.searchsorted(parents, np.arange(n_nodes + 1)).tolist()
        kids, size, suffix = children.tolist(), size.tolist(), tree.suffix
        depth = [0] * n_nodes
        tour: list[int] = []  # depth of each node as the tour meets it
        at = [0] * n  # place in the tour of each suffix
        rank = [0] * n
        seen = 0
        stack = [0]
        upto = begin[:-1]  # next child of each node
        while stack:
            node = stack[-1]
            d = depth[node]
            if suffix[node] >= 0:
                at[suffix[node]] = len(tour)
                rank[suffix[node]] = seen
                seen += 1
                tour.append(d)
                stack.pop()
                continue
            tour.append(d)
            k = upto[node]
            if k == begin[node + 1]:
                tour.pop()
                stack.pop()
                continue
            upto[node] = k + 1
            child = kids[k]
            depth[child] = d + size[child]
            stack.append(child)
        self.rank = rank
        self.at = np.array(at, np.int64)
        self._prepare(np.array(tour, np.int32))

    def _prepare(self, tour: np.ndarray) -> None:
        """Least depths inside blocks, up to each entry and from it on, and over 2**k blocks."""
        padded = np.full(-(-len(tour) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(tour)] = tour
        rows = padded.reshape(-1, BLOCK)
        self.tour = padded
        self.upto = np.minimum.accumulate(rows, axis=1).ravel()
        self.fro = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [rows.min(axis=1)]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(rows):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes i and j have in common: the depth of the deepest
        node over both, which is the least on the tour between them."""
        a, b = self.at[i], self.at[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        left, right = a // BLOCK, b // BLOCK
        found = np.minimum(self.fro[a], self.upto[b])
        far = np.flatnonzero(right - left > 1)
        if len(far):
            low, high = left[far] + 1, right[far]
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            best = np.empty(len(far), np.int32)
            for k in np.unique(level).tolist():
                on = level == k
                row = self.levels[k]
                best[on] = np.minimum(row[low[on]], row[high[on] - (1 << k)])
            found[far] = np.minimum(found[far], best)
        near = np.flatnonzero(left == right)
        if len(near):
            low, high = a[near], b[near]
            best = self.tour[low]
            for k in range(1, BLOCK):
                np.minimum(best, self.tour[np.minimum(low + k, high)], out=best)
            found[near] = best
        return found.astype(np.int64)


def tour_of(s: list[int], symbols: int) -> Tour:
    return Tour(ukkonen(s, symbols), len(s), symbols)


def _next(rank: list[int], sign: int) -> np.ndarray:
    """For each place the next one whose suffix is smaller (sign 1) or larger (-1); -1: none."""
    n = len(rank)
    found = [-1] * n
    stack: list[int] = []
    for i, r in enumerate(rank):
        r *= sign
        while stack and rank[stack[-1]] * sign > r:
            found[stack.pop()] = i
        stack.append(i)
    return np.array(found, np.int64)


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of all runs of a sequence, by start, then period."""
    n = len(words)
    if n < least:
        return np.zeros((0, 3), np.int64)
    _, codes = np.unique(words, return_inverse=True)
    s = codes.ravel().tolist()
    symbols = int(codes.max()) + 2
    right = tour_of([*s, symbols - 1], symbols)
    left = tour_of([*s[::-1], symbols - 1], symbols)
    found = []
    for sign in (1, -1):
        then = _next(right.rank, sign)[:n]
        period = then - np.arange(n)
        # The place behind the last word is the sentinel's and closes no root of a run that
        # goes on; roots longer than a part of all words cannot repeat so often.
        fits = np.flatnonzero((then > 0) & (period * times <= n) & (then <= n))
        for k in range(0, len(fits), CHUNK):
            i = fits[k : k + CHUNK]
            p = period[i]
            ahead = right.agree(i, i + p)
            back = np.zeros(len(i), np.int64)
            inner = np.flatnonzero(i > 0)
            back[inner] = left.agree(n - i[inner], n - i[inner] - p[inner])
            length = p + ahead + back
            keep = length >= np.maximum(least, times * p)
            found.append(np.stack((i - back, length, p), axis=1)[keep])
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


# -- stretches that can hold a run -----------------------------------------------------
def stretches(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last-plus-one) of the stretches of words in which every three neighbours occur
    at least three times. ``text`` numbers the text of each word; stretches keep to one."""
    none = np.zeros(0, np.int64)
    if len(words) < LEAST:
        return none, none
    w = scramble(words.astype(np.uint64) + np.uint64(1))
    three = scramble(scramble(w[:-2] + np.uint64(3) * w[1:-1]) + w[2:])
    at = np.flatnonzero(text[:-2] == text[2:])
    three, of = three[at], text[at].astype(np.uint64)
    # Hashes that meet only keep more places than need be.
    key = scramble(three + scramble(of)) % np.uint64(COARSE)
    some = np.bincount(key.astype(np.int64), minlength=COARSE)[key.astype(np.int64)] >= 3
    at, three, of = at[some], three[some], of[some]
    while len(at):
        _, code, n = np.unique(scramble(three + scramble(of)), return_inverse=True, return_counts=True)
        often = n[code.ravel()] >= 3
        at, three, of = at[often], three[often], of[often]
        # A stretch of k places holds k + 2 words.
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]])
        of = np.cumsum(new).astype(np.uint64)
        long = np.bincount(of.astype(np.int64))[of.astype(np.int64)] >= LEAST - 2
        if often.all() and long.all():
            break
        at, three, of = at[long], three[long], of[long]
    if not len(at):
        return none, none
    new = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    last = np.append(new[1:], len(at)) - 1
    return at[new], at[last] + 3


def text_runs(words: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """The runs of a text, from its stretches: they are put into one sequence with a
    symbol of its own behind each, which no run can cross."""
    joined, places = [], []
    beyond = int(words.max()) + 1
    for k, (low, high) in enumerate(parts):
        joined += [words[low:high], [beyond + k]]
        places += [np.arange(low, high), [-1]]
    found = runs_of(np.concatenate(joined))
    found[:, 0] = np.concatenate(places)[found[:, 0]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most periods, exactly; ties to the smallest start, then period."""
    if not len(runs):
        return None
    share = runs[:, 1] / runs[:, 2]
    close = runs[share >= share.max() * (1 - 1e-9)].tolist()
    start, length, period = min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return start, length, period


RESULT = (
    "n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "strongest struct<start:long,length:long,period:long>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but text, with ``RESULT``: all runs by start, then period; the
    strongest of them; and the words that no run holds behind its first period, joined by one
    blank each."""
    small_batches(docs.sparkSession)
    own = [c.split()[0] for c in RESULT.split(", ")]
    kept = [c for c in docs.columns if c not in ("text", *own)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = "".join(f"`{c}` {kinds[c]}, " for c in kept) + RESULT

    def rows(texts: list[bytes]) -> list[tuple]:
        split = [t.split() for t in texts]  # of bytes: by the six ASCII blanks
        sizes = np.array([len(x) for x in split], np.int64)
        known: dict[bytes, int] = {}
        number = count()
        flat = np.fromiter(
            (known.setdefault(w, next(number)) for x in split for w in x), np.int64, int(sizes.sum())
        )
        ends = np.cumsum(sizes)
        of = np.repeat(np.arange(len(texts)), sizes)
        low, high = stretches(flat, of)
        parts: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            k = int(of[a])
            start = int(ends[k] - sizes[k])
            parts.setdefault(k, []).append((a - start, b - start))
        found = []
        for k, words in enumerate(split):
            if k not in parts:
                found.append((len(words), [], None, b" ".join(words)))
                continue
            runs = text_runs(flat[ends[k] - sizes[k] : ends[k]], parts[k])
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
            stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
            rest = b" ".join([words[i] for i in stay])
            found.append((len(words), runs.tolist(), strongest(runs), rest))
        return found

    def as_run(r) -> dict | None:
        return None if r is None else {"start": r[0], "length": r[1], "period": r[2]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text")).fill_null("")
            texts = texts.cast(pa.large_binary())
            low = 0
            while low < len(texts):
                group, size = [], 0
                while low + len(group) < len(texts) and size < GROUP * 6:
                    group.append(texts[low + len(group)].as_py())
                    size += len(group[-1])
                found = rows(group)
                columns = [batch.column(k).slice(low, len(group)) for k in range(len(kept))]
                n, runs, best, rest = zip(*found, strict=True)
                columns += [
                    pa.array(n, pa.int64()),
                    pa.array([[as_run(r) for r in x] for x in runs], pa.list_(_RUN)),
                    pa.array([as_run(r) for r in best], _RUN),
                    pa.array(rest, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *own])
                low += len(group)

    return docs.select(*kept, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

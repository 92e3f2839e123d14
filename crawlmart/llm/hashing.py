"""Hashes of the words of many texts at once, in numpy. Nothing here knows of Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
LOT = 1 << 20  # bytes of text that are worked on together


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a number modulo 2**64, as many as were ever asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.known = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            steps = np.full(n, self.base, np.uint64)
            steps[0] = 1
            self.known = np.multiply.accumulate(steps)
        return self.known[:n]


_powers, _inverses = _Powers(BASE), _Powers(INVERSE)


def lots(texts: pa.Array, lot: int = LOT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts an Arrow string array into lots: (first row, number of rows, UTF-8 bytes, place of
    each row's first byte). A text larger than a lot comes in several lots of one row each,
    cut behind a blank if there is one. Null is empty."""
    if not len(texts):
        return
    if pa.types.is_large_string(texts.type):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(texts.buffers()[1], np.int32).astype(np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row, n = 0, len(texts)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + lot, side="right")) - 1
        end = min(max(end, row + 1), n)
        low, high = int(offsets[row]), int(offsets[end])
        if high - low <= lot or end > row + 1:
            yield row, end - row, data[low:high], offsets[row:end] - low
        else:
            while low < high:
                cut = min(low + lot, high)
                if cut < high:
                    blanks = np.flatnonzero(is_blank(data[low:cut]))
                    if len(blanks):
                        cut = low + int(blanks[-1]) + 1
                    else:  # one endless word: it is taken whole
                        rest = np.flatnonzero(is_blank(data[cut:high]))
                        cut = cut + int(rest[0]) + 1 if len(rest) else high
                yield row, 1, data[low:cut], np.zeros(1, np.int64)
                low = cut
        row = end


def is_blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def word_bounds(
    data: np.ndarray, rows: np.ndarray, breaks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of each word. A word ends at a blank, at a row's start
    and before a byte marked in ``breaks``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~is_blank(data)
    edge = np.zeros(n + 1, bool)
    edge[rows] = True  # a row without bytes marks the start of the next, or the end
    edge[0] = edge[n] = True
    if breaks is not None:
        edge[:n] |= breaks
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    starts = np.flatnonzero(word & (edge[:n] | ~before))
    ends = np.flatnonzero(word & (edge[1:] | ~after)) + 1
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: differences of a running polynomial, shifted to zero."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n + 1)[:n], out=total[1:])
    raw = (total[ends] - total[starts]) * _inverses(n + 1)[starts]
    return scramble(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))

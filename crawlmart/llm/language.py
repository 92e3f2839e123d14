"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, all but letters becomes one space. The n-grams of each language are
counted over all training rows; the counts, one fixed-size array for each language, come to
the driver and become a matrix of log probabilities, which is broadcast. Scoring adds the
matrix entries of a batch's n-grams for each document.

Defined results: null text and text without a letter is ``und`` with score 0, as is every text
when nothing was learned; ties go to the first language in code point order; equal rows get
equal answers; further columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart.llm import hashing
from crawlmart.llm.common import added_up, small_batches

UNKNOWN = "und"
SPACE = 32


@dataclass(frozen=True)
class Grams:
    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 16
    smoothing: float = 0.5
    max_languages: int = 256  # more are an error: the matrix has buckets x languages entries


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    if not _letters:
        out = np.full(sys.maxunicode + 1, SPACE, np.uint32)
        for i in range(sys.maxunicode + 1):
            if (c := chr(i)).isalpha():
                out[i] = ord(low) if len(low := c.lower()) == 1 else i
        _letters.append(out)
    return _letters[0]


def gram_lots(
    texts: pa.Array, grams: Grams
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each lot: first row, number of rows, the n-grams' buckets, the row (in the lot) of
    each n-gram, and the number of letters of each row."""
    table = _letter_table()
    salts = hashing.scramble(np.arange(1, 1 + max(grams.orders), dtype=np.uint64)) | np.uint64(1)
    for first, n, data, rows in hashing.lots(texts):
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts_at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[rows]
        sizes = np.diff(np.append(starts_at, len(points)))
        row = np.repeat(np.arange(n), sizes)
        letters = table[np.minimum(points, sys.maxunicode)]
        is_letter = letters != SPACE
        count = np.bincount(row[is_letter], minlength=n)
        new_row = np.append(True, row[1:] != row[:-1])[: len(row)]
        before = np.append(False, is_letter[:-1])[: len(row)]
        keep = is_letter | (before & ~new_row)  # one space behind each word
        x, row = letters[keep].astype(np.uint64), row[keep]
        buckets, of = [], []
        for k in grams.orders:
            m = len(x) - k + 1
            if m <= 0:
                continue
            total = np.full(m, k, np.uint64)
            for i in range(k):
                total += x[i : i + m] * salts[i]
            inside = row[:m] == row[k - 1 : k - 1 + m]
            hashed = hashing.scramble(total) % np.uint64(grams.buckets)
            buckets.append(hashed[inside].astype(np.int64))
            of.append(row[:m][inside])
        empty = np.zeros(0, np.int64)
        yield (
            first, n,
            np.concatenate(buckets) if buckets else empty,
            np.concatenate(of) if of else empty,
            count,
        )


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x buckets
    prior: np.ndarray
    grams: Grams


def train(rows: DataFrame, grams: Grams = Grams()) -> Model:
    """From all rows with a text and a non-null lang."""
    small_batches(rows.sparkSession)
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in langs:
                docs[lang] = docs.get(lang, 0) + 1
            for first, n, buckets, of, _ in gram_lots(batch.column("text"), grams):
                names, code = np.unique(np.array(langs[first : first + n], object), return_inverse=True)
                flat = np.bincount(
                    code[of] * grams.buckets + buckets, minlength=len(names) * grams.buckets
                )
                for lang, counts in zip(names, flat.reshape(-1, grams.buckets), strict=True):
                    seen[lang] = seen[lang] + counts if lang in seen else counts
        # All languages of a task, so that many small ones do not wait together.
        for lang in docs:
            counts = seen.get(lang, np.zeros(grams.buckets, np.int64)).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([docs[lang]], pa.int64()), pa.array([counts.tobytes()], pa.binary())],
                ["lang", "docs", "counts"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(grams.buckets, np.int64)
        for raw in table.column("counts"):
            total += np.frombuffer(raw.as_py(), "<i8")
        return pa.table(
            [
                table.column("lang").slice(0, 1),
                pa.array([sum(table.column("docs").to_pylist())], pa.int64()),
                pa.array([total.tobytes()], pa.binary()),
            ],
            ["lang", "docs", "counts"],
        )

    schema = "lang string, docs long, counts binary"
    counted = added_up(rows.mapInArrow(count, schema), "lang", add, schema)
    got = counted.limit(grams.max_languages + 1).collect()
    if len(got) > grams.max_languages:
        raise ValueError(f"more than {grams.max_languages} languages to learn")
    got.sort(key=lambda r: r["lang"])
    counts = np.array([np.frombuffer(r["counts"], "<i8") for r in got], np.float64)
    counts = counts.reshape(len(got), grams.buckets) + grams.smoothing
    docs = np.array([r["docs"] for r in got], np.float64)
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return Model([r["lang"] for r in got], logs, np.log(docs / max(docs.sum(), 1.0)), grams)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, the posterior of it."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            size = batch.num_rows
            total = np.tile(known.prior, (size, 1))
            letters = np.zeros(size, np.int64)
            for first, n, buckets, of, count in gram_lots(
                batch.column("text").fill_null(""), known.grams
            ):
                letters[first : first + n] += count
                for i, logs in enumerate(known.logs):
                    total[first : first + n, i] += np.bincount(of, logs[buckets], minlength=n)
            name, score = [UNKNOWN] * size, np.zeros(size)
            if known.languages:
                best = total.argmax(axis=1)
                top = total[np.arange(size), best]
                share = 1 / np.exp(total - top[:, None]).sum(axis=1)
                for k in np.flatnonzero(letters):
                    name[k], score[k] = known.languages[best[k]], share[k]
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(name, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def fold(doc_id: Column | str, n: int = 3) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % n

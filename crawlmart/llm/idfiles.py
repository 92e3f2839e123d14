"""Token ids in binary files, with document borders in Elias-Fano code.

Documents are put in ascending order of their ids over range partitions, and each partition
cuts its stretch into files of about ``file_ids`` token ids. A file holds its ids one behind
the other, two or four bytes each, and says where its documents begin by a monotone sequence
in Elias-Fano code: the low bits of each border side by side, the high bits in unary, and a
count of the ones before every 512 bits. ``Sequence.select`` finds a border from these three
alone, so a border takes about two bits more than the logarithm of a document's mean length
and no table of 64-bit offsets exists. The document ids of a file are such a sequence too. A
manifest beside the files says how many ids stand before each file.

A file is: the header (``HEADER``), the document ids, the borders (``Sequence.dump``), the
token ids, one end byte. Everything is little-endian. Files are written and read by Spark, so
any file system it knows will do, and a lost task leaves no half file behind.

Defined results: null and empty texts have the end id alone; rows with a null doc_id come
first; rows of equal doc_id follow the hash of their text, repeated rows each count, in the
order of the scan, which no result shows; an empty table gives a manifest and no rows.
Further columns are ignored. A document is never split between files.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm.common import small_batches

END = 2  # the id behind each document
FILE_IDS = 1 << 21  # ids of a file, about
KNOWN = 1 << 20  # pieces of text that a worker remembers, about
LEARN = 512  # of them that are encoded together
LOT = 1 << 21  # characters of texts that are worked on together, or one longer text
LONGEST = 64  # characters of a piece that is remembered
BLOCK = 512  # bits between two counts of a sequence
MAGIC = b"EFTOKID1"
# magic, part, number in the part, documents, those of them without an id, ids, bytes per id
HEADER = "<8sIIIIIB"
SEQUENCE = "<qQIB"  # least value, largest less that, length, low bits


# -- Elias-Fano ------------------------------------------------------------------------
def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value side by side, in bytes."""
    if not width:
        return np.zeros(0, np.uint8)
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :width], bitorder="little")


@dataclass(frozen=True)
class Sequence:
    """A non-decreasing sequence of integers, each found without the others."""

    least: int
    span: int
    n: int
    low: int  # bits of a value that are stored as they are
    low_bits: np.ndarray
    high_bits: np.ndarray
    ones: np.ndarray  # in the high bits before each block

    @staticmethod
    def of(values: np.ndarray) -> Sequence:
        values = np.asarray(values, np.int64)
        least = int(values[0]) if len(values) else 0
        beyond = values.view(np.uint64) - np.uint64(least % (1 << 64))
        span = int(beyond[-1]) if len(values) else 0
        low = max(0, (span // max(1, len(values))).bit_length() - 1)
        at = (beyond >> np.uint64(low)).astype(np.int64) + np.arange(len(values))
        size = -(-(int(at[-1]) + 1 if len(values) else 0) // BLOCK) * BLOCK
        high = np.zeros(size, np.uint8)
        high[at] = 1
        ones = np.cumsum(high.reshape(-1, BLOCK).sum(axis=1), dtype=np.int64)
        before = np.concatenate(([0], ones[:-1])).astype("<u4")[: len(ones)]
        return Sequence(
            least, span, len(values), low, _bits(beyond, low), np.packbits(high, bitorder="little"), before
        )

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The values with these ranks (from 0): the block of the rank's one by its count,
        the one's place inside the block, and the low bits."""
        ranks = np.asarray(ranks, np.int64)
        found = np.empty(len(ranks), np.int64)
        blocks = self.high_bits.reshape(-1, BLOCK // 8)
        for k in range(0, len(ranks), 4096):
            r = ranks[k : k + 4096]
            block = np.searchsorted(self.ones, r, side="right") - 1
            seen = np.cumsum(np.unpackbits(blocks[block], axis=1, bitorder="little"), axis=1, dtype=np.int16)
            inside = (seen <= (r - self.ones[block])[:, None]).sum(axis=1)
            value = (block * BLOCK + inside - r).astype(np.uint64) << np.uint64(self.low)
            if self.low:
                bit = r[:, None] * self.low + np.arange(self.low)
                bits = (self.low_bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
                weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
                value |= (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
            found[k : k + 4096] = (value + np.uint64(self.least % (1 << 64))).view(np.int64)
        return found

    def dump(self) -> bytes:
        head = struct.pack(SEQUENCE, self.least, self.span, self.n, self.low)
        sizes = struct.pack("<II", len(self.low_bits), len(self.high_bits))
        return head + sizes + self.low_bits.tobytes() + self.high_bits.tobytes() + self.ones.tobytes()

    @staticmethod
    def load(raw: memoryview, at: int) -> tuple[Sequence, int]:
        """The sequence that begins at a byte, and where it ends."""
        least, span, n, low = struct.unpack_from(SEQUENCE, raw, at)
        at += struct.calcsize(SEQUENCE)
        n_low, n_high = struct.unpack_from("<II", raw, at)
        at += 8
        low_bits = np.frombuffer(raw, np.uint8, n_low, at)
        high_bits = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        ones = np.frombuffer(raw, "<u4", n_high * 8 // BLOCK, at + n_low + n_high)
        end = at + n_low + n_high + ones.nbytes
        return Sequence(least, span, n, low, low_bits, high_bits, ones), end


# -- tokens ----------------------------------------------------------------------------
# Characters of which every version of Unicode says the same: letters, digits, white space,
# others. Fixed values.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
DIGITS = "0-9"
BLANKS = "\t\n\r "
OTHERS = "!-/:-@\\[-`{-~\u2010-\u2015\u2018-\u201f\u2026\u20ac"
SHORT = ("s", "t", "m", "d", "re", "ve", "ll")  # what an apostrophe keeps behind it
_UNKNOWN = re.compile(f"[^{LETTERS}{DIGITS}{BLANKS}{OTHERS}]")
_INSIDE = re.compile(r"\s \s")
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")
_BLANK = re.compile("(?= )")
LETTER, DIGIT, OTHER, WHITE, BORDER = 1, 2, 3, 4, 5


def _kinds() -> np.ndarray:
    """The kind of each character up to the largest known one."""
    every = "".join(map(chr, range(0x2100)))
    kinds = np.zeros(len(every), np.uint8)
    for kind, chars in ((LETTER, LETTERS), (DIGIT, DIGITS), (OTHER, OTHERS), (WHITE, BLANKS)):
        kinds[[m.start() for m in re.finditer(f"[{chars}]", every)]] = kind
    kinds[0] = BORDER
    return kinds


KINDS = _kinds()


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts of known characters with a zero between each two.

    A piece is a stretch of one kind; a blank goes with what follows it, and the last
    character of longer white space is a piece of its own if it does not. An apostrophe that
    begins a piece keeps the letters of ``SHORT`` and ends with them."""
    kinds = KINDS[codes]
    solid = kinds <= OTHER
    start = np.ones(len(codes), bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == BORDER)
    last = (kinds[:-1] == WHITE) & solid[1:]
    start[:-1] |= last
    start[1:][last & (codes[:-1] == 32)] = False
    after = np.concatenate((codes, [0, 0, 0]))
    at = np.flatnonzero((codes == 39) & start)
    for short in SHORT:
        fits = at[np.all([after[at + 1 + k] == ord(c) for k, c in enumerate(short)], axis=0)]
        start[fits + 1] = False
        fits = fits + 1 + len(short)
        start[fits[fits < len(codes)]] = True
    return start


class _Ids(dict):
    """Ids, as bytes, of pieces of text: a text's ids are those of its pieces.

    A byte-level vocabulary never joins what its standard pattern splits. Texts of known
    characters are split by it all at once. Any other is cut before its blanks: no blank is joined
    to what stands before it, unless it is inside a longer stretch of white space, and a text
    with such a stretch is cut only between two other characters and a blank. Any other kind
    of tokenizer gets whole texts.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("H" if max(self.tokenizer.get_vocab_size() - 1, end) < 1 << 16 else "I")
        self["\0"] = b""  # the border between two texts
        made = json.loads(self.tokenizer.to_str())
        split = made.get("pre_tokenizer") or {}
        self.marks = [t["content"] for t in made.get("added_tokens", [])]
        self.by_pieces = (
            made.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space", True)
            and made["model"].get("dropout") is None
            and not any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                for t in made.get("added_tokens", [])
            )
        )

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind.char, x.ids).tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; what is new is encoded together."""
        found = list(map(self.get, pieces))
        new = [k for k, x in enumerate(found) if x is None]
        if len(self) + len(new) > KNOWN:
            self.clear()
            self["\0"] = b""  # the border between two texts
        words = [i for i in new if pieces[i][:1] == " " and pieces[i][1:].isalpha()]
        for some, encode in ((words, self._words), (list(set(new).difference(words)), self._bytes)):
            for k in range(0, len(some), LEARN):
                lot = some[k : k + LEARN]
                for i, ids in zip(lot, encode([pieces[i] for i in lot]), strict=True):
                    found[i] = ids
                    if len(pieces[i]) <= LONGEST:
                        self[pieces[i]] = ids
        return found

    def _words(self, words: list[str]) -> list[bytes]:
        """The same as ``_bytes`` for words behind a blank each, in one text."""
        found = self.tokenizer.encode("".join(words), add_special_tokens=False)
        word = np.array(found.word_ids, np.int64)
        if not len(word) or word[-1] != len(words) - 1:
            return self._bytes(words)
        raw = array(self.kind.char, found.ids).tobytes()
        cut = (np.searchsorted(word, np.arange(len(words) + 1)) * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def _known(self, texts: list[str]) -> list[bytes]:
        """For texts of known characters."""
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = np.flatnonzero(piece_starts(codes))
        upto = np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800), dtype=np.int32)
        data = joined.encode()
        offsets = np.append(np.where(starts > 0, upto[starts - 1], 0), len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy()
        found = self._learn(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        first = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(found), self.kind)
        n = size[index]
        stop = np.cumsum(n)
        out = ids[np.arange(int(stop[-1])) + np.repeat(first[index] - (stop - n), n)]
        ends = stop[codes[starts] == 0]
        return [out[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_pieces:
            return self._bytes(texts)
        found: list[bytes] = [b""] * len(texts)
        known = []
        for k, text in enumerate(texts):
            if not _UNKNOWN.search(text) and not any(m in text for m in self.marks):
                known.append(k)
            else:
                found[k] = b"".join(self._learn((_BETWEEN if _INSIDE.search(text) else _BLANK).split(text)))
        if known:
            for k, ids in zip(known, self._known([texts[k] for k in known]), strict=True):
                found[k] = ids
        return found


_loaded: dict[tuple[str, int], _Ids] = {}


def _ids(path: str, end: int) -> _Ids:
    """One per worker process: what it has learnt serves the tasks that follow."""
    if (path, end) not in _loaded:
        _loaded[path, end] = _Ids(path, end)
    return _loaded[path, end]


# -- files -----------------------------------------------------------------------------
def file_bytes(part: int, number: int, doc_ids: list, parts: list[bytes], kind: np.dtype) -> bytes:
    """One file: documents in order, with their ids."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // kind.itemsize
    borders = np.concatenate(([0], np.cumsum(sizes)))
    known = np.array([x for x in doc_ids if x is not None], np.int64)
    head = struct.pack(
        HEADER, MAGIC, part, number, len(parts), len(parts) - len(known), int(borders[-1]), kind.itemsize
    )
    return b"".join([head, Sequence.of(known).dump(), Sequence.of(borders).dump(), *parts])


@dataclass(frozen=True)
class File:
    part: int
    number: int
    n_docs: int
    n_null: int
    doc_ids: Sequence
    borders: Sequence
    ids: np.ndarray

    @staticmethod
    def of(raw: bytes) -> File:
        magic, part, number, n_docs, n_null, n_ids, width = struct.unpack_from(HEADER, raw, 0)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        view = memoryview(raw)
        doc_ids, at = Sequence.load(view, struct.calcsize(HEADER))
        borders, at = Sequence.load(view, at)
        ids = np.frombuffer(view, "<u2" if width == 2 else "<u4", n_ids, at)
        return File(part, number, n_docs, n_null, doc_ids, borders, ids)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the file."""
        low, high = self.borders.select(np.array([k, k + 1]))
        return self.ids[low:high]


def encoded(docs: DataFrame, tokenizer: str, end: int = END, file_ids: int = FILE_IDS) -> DataFrame:
    """The column ``file``: the bytes of each file."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The place in the scan parts repeated rows, so that no range holds all copies of one.
    order = ["doc_id", "of_text", "place"]
    rows = rows.select("*", F.xxhash64("text").alias("of_text"), F.monotonically_increasing_id().alias("place"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(tokenizer, end)
        stop = np.array([end], ids.kind).tobytes()
        part = number = size = 0
        doc_ids: list = []
        parts: list[bytes] = []

        def file() -> pa.RecordBatch:
            raw = file_bytes(part, number, doc_ids, parts, ids.kind)
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["file"])

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            low, texts = 0, batch.column("text")
            while low < batch.num_rows:
                lot, length = [], 0
                while low + len(lot) < batch.num_rows and length < LOT:
                    lot.append(texts[low + len(lot)].as_py() or "")
                    length += len(lot[-1])
                names = batch.column("doc_id").slice(low, len(lot)).to_pylist()
                for doc_id, found in zip(names, ids.of(lot), strict=True):
                    found += stop
                    if parts and size + len(found) > file_ids * ids.kind.itemsize:
                        yield file()
                        doc_ids, parts, size, number = [], [], 0, number + 1
                    doc_ids.append(doc_id)
                    parts.append(found)
                    size += len(found)
                low += len(lot)
        if parts:
            yield file()

    return dealt.mapInArrow(cut, "file binary")


def write(
    docs: DataFrame, path: str, tokenizer: str, end: int = END, file_ids: int = FILE_IDS
) -> None:
    """Writes ``path``/ids, the files, and ``path``/manifest: part, number, n_docs, n_ids and
    ``before``, the number of ids in all files before.

    The driver sees one number per range partition, which is a setting, not the corpus."""
    spark = docs.sparkSession
    # A string's bytes are written as they are; a row is a file, its line end the end byte.
    raw = encoded(docs, tokenizer, end, file_ids).select(F.col("file").cast("string"))
    raw.write.option("maxRecordsPerFile", 1).text(f"{path}/ids")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [struct.unpack(HEADER, x.as_py()) for x in batch.column("head")]
            columns = [[h[k] for h in found] for k in (1, 2, 3, 5)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "number", "n_docs", "n_ids"])

    written = spark.read.format("binaryFile").load(f"{path}/ids")
    head = written.select(F.substring("content", 1, struct.calcsize(HEADER)).alias("head"))
    files = head.mapInArrow(heads, "part int, number int, n_docs long, n_ids long")
    files = runtime.materialize(files, "heads")
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    upto = np.concatenate(([0], np.cumsum([r["n"] for r in totals], dtype=np.int64))).tolist()
    starts = [(r["part"], x) for r, x in zip(totals, upto, strict=False)]
    parts = spark.createDataFrame(starts, "part int, start long")
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.join(F.broadcast(parts), "part")
    manifest = manifest.withColumn(
        "before", F.col("start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    )
    manifest.drop("start").write.parquet(f"{path}/manifest")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, with ``ids``, the
    ids of each document, little-endian in 32 bits each."""
    small_batches(spark)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                file = File.of(raw.as_py())
                borders = file.borders.select(np.arange(file.n_docs + 1))
                known = file.doc_ids.select(np.arange(file.doc_ids.n)).tolist()
                wide = file.ids.astype("<u4")
                each = [wide[a:b] for a, b in zip(borders, borders[1:])]
                columns = [
                    pa.array([file.part] * file.n_docs, pa.int32()),
                    pa.array([file.number] * file.n_docs, pa.int32()),
                    pa.array([None] * file.n_null + known, pa.int64()),
                    pa.array(borders[:-1], pa.int64()),
                    pa.array(np.diff(borders), pa.int64()),
                    pa.array([zlib.crc32(x) for x in each], pa.int64()),
                ]
                names = ["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array([x.tobytes() for x in each], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long"
    files = spark.read.format("binaryFile").load(f"{path}/ids").select("content")
    found = files.mapInArrow(documents, schema + ", ids binary" * ids)
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "number", "before")
    start = (F.col("before") + F.col("at")).alias("start")
    return found.join(manifest, ["part", "number"]).select(
        "doc_id", start, "n_tokens", "ids_crc32", *["ids"] * ids
    )

"""Files of token ids, periodic runs and hard negatives against brute force."""

import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import words
from tokenizers import Tokenizer

from crawlmart import runtime
from crawlmart.llm import idfiles, negatives, periods
from crawlmart.llm.queries import QUERIES, bytes_tokenizer_path

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- files of token ids ----------------------------------------------------------------
def ids_of(text, tokenizer):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, idfiles.END]


def test_ids_come_back_from_the_files(spark, odd_dir, odd):
    tokenizer = Tokenizer.from_file(bytes_tokenizer_path())
    found = [r.asDict() for r in QUERIES["op11_id_files"](spark, odd_dir).collect()]
    wanted = Counter()
    for doc_id, text, *_ in odd:
        ids = np.array(ids_of(text, tokenizer), "<u4")
        wanted[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == wanted
    found.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]


def test_small_files_over_many_partitions(spark):
    """Many files, a hot id, negative ids, and the ids themselves."""
    rows = [(k % 40 - 20 if k % 3 else 7, f"text {k % 11}  of\n some words " * (k % 5)) for k in range(300)]
    rows += [(None, "no id"), (None, None), (2**62, "far"), (-(2**62), "away")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = runtime.new_dir(spark, "ids-test")
    idfiles.write(docs, path, bytes_tokenizer_path(), file_ids=100)
    assert spark.read.format("binaryFile").load(f"{path}/ids").count() > 20
    tokenizer = Tokenizer.from_file(bytes_tokenizer_path())
    found = idfiles.read(spark, path).orderBy("start").collect()
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found]
    assert Counter((i, tuple(x)) for i, x in got) == Counter((i, tuple(ids_of(t, tokenizer))) for i, t in rows)
    assert [r["start"] for r in found] == np.cumsum([0, *(len(x) for _, x in got)])[:-1].tolist()
    files = [idfiles.File.of(bytes(r["content"])) for r in spark.read.format("binaryFile").load(f"{path}/ids").collect()]
    for file in files:  # one document alone, by its rank
        borders = file.borders.select(np.arange(file.n_docs + 1))
        for k in range(file.n_docs):
            assert (file.document(k) == file.ids[borders[k] : borders[k + 1]]).all()


ODD_TEXTS = [
    "", " ", "  ", "   x", "a  b", "a   b ", "a \n b", "a\n\n b", "\ta\t b", "don't  don't 's", "été à l'île",
    "x" * 5000, "a b   c", "a \x1c b", " 12 345", "<|endoftext|> a <|endoftext|>", "中文 字 🙂 🙂", "a b\r\n c",
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_pieces_have_the_ids_of_the_whole(text):
    ids = idfiles._Ids(bytes_tokenizer_path(), idfiles.END)
    assert ids.by_pieces
    wanted = ids.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):  # remembered and not
        assert np.frombuffer(ids.of([text])[0], ids.kind).tolist() == wanted


def test_random_white_space_has_the_ids_of_the_whole():
    ids = idfiles._Ids(bytes_tokenizer_path(), idfiles.END)
    draw = np.random.default_rng(5)
    for _ in range(2000):
        text = "".join(draw.choice(list("  \n\tab1'.s é"), int(draw.integers(0, 14))))
        wanted = ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.of([text])[0], ids.kind).tolist() == wanted, repr(text)


def test_another_kind_of_tokenizer_gets_whole_texts(tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = idfiles._Ids(path, 0)
    assert not ids.by_pieces
    wanted = Tokenizer.from_file(path).encode("Some  Words here", add_special_tokens=False).ids
    assert np.frombuffer(ids.of(["Some  Words here"])[0], ids.kind).tolist() == wanted


def test_borders_take_little_space():
    draw = np.random.default_rng(3)
    for mean in (3, 100, 5000):
        borders = np.concatenate(([0], np.cumsum(draw.integers(1, 2 * mean, 20_000))))
        bits = 8 * len(idfiles.Sequence.of(borders).dump()) / len(borders)
        assert bits < math.log2(mean) + 3.2


def test_sequences_of_any_shape_come_back():
    draw = np.random.default_rng(4)
    for k in range(200):
        n = int(draw.integers(0, 1500))
        values = np.sort(draw.integers(-(1 << int(draw.integers(1, 62))), 1 << int(draw.integers(1, 62)), n))
        values = np.repeat(values[:3], 500) if k % 5 == 0 else values
        got, end = idfiles.Sequence.load(memoryview(b"x" + idfiles.Sequence.of(values).dump()), 1)
        assert (got.select(np.arange(len(values))) == values).all()


# -- periodic runs ---------------------------------------------------------------------
def brute_runs(w):
    n, out = len(w), []
    for p in range(1, n // 4 + 1):
        k = 0
        while k + p < n:
            if w[k] != w[k + p]:
                k += 1
                continue
            j = k
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - k + p
            if length >= max(6, 4 * p) and not any(
                all(w[x] == w[x + q] for x in range(k, k + length - q)) for q in range(1, p)
            ):
                out.append((k, length, p))
            k = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_op12(doc_id, text):
    w = words(text)
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = brute_runs(w) if n < 3000 else None
    if runs is None:
        return None
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
        sha(" ".join(w[i] for i in range(n) if i not in gone)),
    )


def test_runs_of_the_documents(spark, odd_dir, odd):
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    found = Counter(tuple(r[c] for c in columns) for r in QUERIES["op12_periodic_runs"](spark, odd_dir).collect())
    assert sum(found.values()) == len(odd)
    wanted = Counter(brute_op12(i, t) for i, t, *_ in odd)
    long = wanted.pop(None, 0)
    assert long == 1 and wanted - found == Counter() and sum((found - wanted).values()) == long
    assert sum(r[1] > 0 for r in found) > 5


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_words(letters):
    draw = np.random.default_rng(letters)
    for k in range(400):
        w = draw.integers(0, letters, int(draw.integers(0, 70)))
        if k % 3 == 0 and len(w) > 6:
            p = int(draw.integers(1, 9))
            w = w[np.where(np.arange(len(w)) > 3, np.arange(len(w)) % p, np.arange(len(w)))]
        wanted = brute_runs(w.tolist())
        assert [tuple(r) for r in periods.runs_of(w).tolist()] == wanted
        low, high = periods.stretches(w, np.zeros(len(w), np.int64))
        parts = list(zip(low.tolist(), high.tolist(), strict=True))
        assert [tuple(r) for r in (periods.text_runs(w, parts).tolist() if parts else [])] == wanted


def test_stretches_keep_to_their_text():
    w = np.array([1, 2] * 3 + [1, 2] * 3)
    low, _ = periods.stretches(w, np.repeat([0, 1], 6))
    assert not len(low)  # six words of period two are no run; twelve would be one
    low, high = periods.stretches(w, np.zeros(12, np.int64))
    assert (low.tolist(), high.tolist()) == ([0], [12])


def test_the_tree_gives_common_lengths():
    draw = np.random.default_rng(9)
    for _ in range(60):
        s = draw.integers(0, 3, int(draw.integers(2, 120))).tolist()
        tour = periods.tour_of([*s, 3], 4)
        i, j = draw.integers(0, len(s), (2, 200))
        keep = i != j
        i, j = i[keep], j[keep]
        wanted = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            wanted.append(k)
        assert tour.agree(i, j).tolist() == wanted
        order = sorted(range(len(s) + 1), key=lambda k: [*s, 3][k:])
        assert [tour.rank[k] for k in order] == list(range(len(s) + 1))


def test_long_texts_of_few_words(spark):
    rows = [
        (1, "a " * 50_000, "x"), (2, "b c " * 20_000 + "d", "x"), (3, " ".join(f"w{k % 9000}" for k in range(50_000)), "y"),
        (4, None, None), (5, "\n\t ", "z"), (5, "\n\t ", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = {r["doc_id"]: r for r in periods.find(docs).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 50_000, 1)]
    assert [tuple(r) for r in found[2]["runs"]] == [(0, 40_000, 2)]
    assert [tuple(r) for r in found[3]["runs"]] == [(0, 50_000, 9_000)]
    assert [found[k]["collapsed"] for k in (1, 2, 4, 5)] == ["a", "b c d", "", ""]
    assert found[3]["collapsed"] == " ".join(f"w{k}" for k in range(9000))
    assert [found[k]["n_words"] for k in (1, 2, 3, 4, 5)] == [50_000, 40_001, 50_000, 0, 0]


# -- hard negatives --------------------------------------------------------------------
def brute_negatives(rows):
    """rows: (vec_id, embedding, label), as in the table."""
    kept = []
    for vec_id, vector, label in sorted(set((i, None if v is None else tuple(v), x) for i, v, x in rows), key=str):
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * float(x)) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for a, va, la in kept:
        if a % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(va, v, strict=True)), i, label)
            for i, v, label in kept
            if i != a and len(v) == len(va)
        ]
        scored.sort(key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == la][:5]:
            fits = [r for r in scored if r[2] != la and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(fits, 1)]
    return out


NAMES = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def mined(df):
    return Counter(tuple(r[c] for c in NAMES) for r in df.collect())


def embeddings(folder, rows):
    ids, vectors, labels = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 3
    table = {
        "vec_id": pa.array(ids, pa.int64()),
        "embedding": pa.array(vectors, pa.list_(pa.float32())),
        "label": pa.array(labels, pa.int32()),
    }
    table |= {c: pa.array([c] * len(ids), pa.string()) for c in ("anchor", "vec", "dims", "place", "x", "y")}
    pq.write_table(pa.table(table), f"{folder}/embeddings.parquet")


def test_negatives_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()]
    wanted = brute_negatives(rows)
    assert wanted and mined(QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.01")) == Counter(wanted)


def test_negatives_of_odd_rows(spark, tmp_path):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(0.1, 0.4, 8).tolist(), int(draw.integers(0, 10))) for k in range(260)]
    rows += [(k, draw.integers(0, 2, 8).astype(float).tolist(), k % 2) for k in range(300, 420)]  # many ties
    rows += [(500, [1.0] * 8, None), (501, None, 1), (None, [1.0] * 8, 1), (600, [math.nan] + [1.0] * 7, 1)]
    rows += [(700, [math.inf] + [1.0] * 7, 1), (701, [None] + [1.0] * 7, 1), (800, [], 1), (801, [], 2)]
    rows += [(900, [0.0] * 8, 3), (1000, [3e4] * 8, 1), (1001, [2.9e4] * 8, 1), (1002, [2.8e4] * 8, 2), (1100, [1.0, 2.0], 4)]
    rows += rows[:50]
    embeddings(tmp_path, rows)
    wanted = brute_negatives(rows)
    assert len(wanted) > 40
    assert mined(QUERIES["op13_hard_negatives"](spark, str(tmp_path))) == Counter(wanted)


def test_a_fine_grid_gives_the_same(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(8)
    rows = [(k, draw.normal(0.1, 0.4, 6).tolist(), int(draw.integers(0, 10))) for k in range(400)]
    embeddings(tmp_path, rows)
    monkeypatch.setattr(negatives, "grid", lambda *_: (3, 7))
    assert mined(QUERIES["op13_hard_negatives"](spark, str(tmp_path))) == Counter(brute_negatives(rows))


def test_products_of_residues_are_exact():
    draw = np.random.default_rng(6)
    for _ in range(150):
        d = int(draw.integers(1, 300))
        most = int(draw.choice([2, 300, 70_000, 1 << 27]))
        a, b = draw.integers(-most, most, (4, d)), draw.integers(-most, most, (6, d))
        wanted = a.astype(object) @ b.astype(object).T
        primes = negatives.primes_for(d, negatives._bound(a, b))
        assert (negatives.products(a, b, primes) == wanted).all()
    a, b = draw.integers(-300, 300, (4, 9000)), draw.integers(-300, 300, (6, 9000))
    assert (negatives.products(a, b, negatives.primes_for(9000, negatives._bound(a, b))) == a @ b.T).all()


@pytest.mark.parametrize(("anchors", "rows"), [(0, 0), (1, 50), (10**5, 10**7), (10**7, 10**9)])
def test_cells_are_bounded(anchors, rows):
    on_a, on_r = negatives.grid(anchors, rows, 152.0, 1000)
    assert anchors / on_a * 752 + rows / on_r * 152 <= negatives.CELL_BYTES or on_a * on_r >= anchors * rows
    if rows > 10**6:  # sent about sqrt(cells) times
        assert anchors * 752 * on_r + rows * 152 * on_a < 4 * math.sqrt(on_a * on_r * anchors * 752 * rows * 152)

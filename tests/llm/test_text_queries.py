"""The queries over documents against brute force, on odd rows and on none."""

import hashlib
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from check import compare, duck  # noqa: E402
from crawlmart.llm import mixing  # noqa: E402
from crawlmart.llm.queries import ORACLES, QUERIES, tokenizer_path  # noqa: E402


def rows(df):
    return [r.asDict() for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, empty_dir, name):
    found = queries()[name](spark, empty_dir).collect()
    assert [r["conv_id"] for r in found] == [-7] if name.startswith("op10") else not found


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, name) == ""
    assert set(ORACLES) <= set(oracle_sql())


def test_every_numbered_query_is_there():
    assert [sum(q.startswith(f"op{n}_") for q in queries()) for n in range(1, 14)] == [1] * 13


def test_mix_reaches_its_targets(spark, odd_dir, odd):
    found = rows(QUERIES["op1_source_mix"](spark, odd_dir))
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, *_ in odd)
    size = Counter()
    for _, text, _, source in odd:
        size[source] += len(brute.words(text))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    targets = dict(
        zip(order, brute.water_filling([size[s] for s in order], weights, 1.5, 2), strict=True)
    )
    taken = Counter()
    for r in found:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in order)
    again = rows(QUERIES["op1_source_mix"](spark, odd_dir))
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(found, key=key) == sorted(again, key=key)


def test_every_stretch_of_the_mix_is_near_the_weights(spark, odd_dir, odd):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text", "source")
    placed, mixed = mixing.plan(docs)
    source = {r["id"]: r["source"] for r in rows(placed)}
    slots = sorted({(r["slot"], source[r["id"]]) for r in rows(mixed)}, key=lambda x: x[0])
    n, whole = len(slots), Counter(s for _, s in slots)
    assert len({slot for slot, _ in slots}) == n > 100
    for low in range(0, n, n // 7):
        for high in range(low + n // 7, n + 1, n // 7):
            part = Counter(s for _, s in slots[low:high])
            # A stretch of van der Corput points is off by at most 2 log2(n) + 2 in an interval.
            off = 2 * np.log2(n) + 2
            assert all(abs(part[s] - whole[s] * (high - low) / n) <= off for s in whole)
    found = rows(QUERIES["op1_source_mix"](spark, odd_dir))
    first = {}
    for r in rows(mixed):
        key = (r["id"], r["at"], r["doc_id"])
        first[key] = min(first.get(key, r["slot"]), r["slot"])
    wanted = Counter((i, slot) for (_, _, i), slot in first.items())
    got = Counter((r["doc_id"], r["first_slot"]) for r in found if r["first_slot"] is not None)
    assert got == wanted and all((r["first_slot"] is None) == (r["taken"] == 0) for r in found)


def test_components_are_those_of_all_pairs(spark, odd_dir, odd):
    found = rows(QUERIES["op3_jaccard_join"](spark, odd_dir))
    sets = [brute.shingles(text) for _, text, *_ in odd]
    least = defaultdict(list)
    parts = brute.components(sets)
    for part, (i, *_) in zip(parts, odd, strict=True):
        if i is not None:
            least[part].append(i)
    wanted = Counter(
        (i, len(s), min(least[p]) if s and least[p] else i)
        for (i, *_), s, p in zip(odd, sets, parts, strict=True)
    )
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == wanted


@pytest.mark.parametrize(
    ("name", "kinds"), [("op4_secret_scan", brute.SECRETS), ("op9_private_data", brute.PERSONAL)]
)
def test_base_spans(spark, odd_dir, odd, name, kinds):
    found = rows(QUERIES[name](spark, odd_dir))
    base = [(i, brute.spans(text, kinds)) for i, text, *_ in odd]
    wanted = Counter(
        (i, sha(brute.written(b)), *(sum(s[0] == k for s in b) for k in kinds)) for i, b in base
    )
    got = Counter((r["doc_id"], r["base_sha256"], *(r[f"n_{k}"] for k in kinds)) for r in found)
    assert got == wanted
    every = {r["doc_id"]: set(r["spans"].split(",")) for r in found}
    for i, b in base:
        if i is not None:
            assert {brute.written([s]) for s in b} <= every[i]


def test_weak_secrets_need_their_counterparts(spark, odd_dir, odd):
    found = {r["doc_id"]: r["spans"] for r in rows(QUERIES["op4_secret_scan"](spark, odd_dir))}
    text = next(t for i, t, *_ in odd if i == 900012)
    spans = [s.split(":") for s in found[900012].split(",")]
    assert [k for k, *_ in spans] == ["assign", "hex", "access", "secret", "endpoint"]
    by = {k: text[int(a) : int(b)] for k, a, b in spans}
    assert by["secret"] == "wJalrXUtnFEMIxK7MDENGxbPxRfiCYEXAMPLEKEY"
    assert by["endpoint"] == "https://s3.example.org/x"
    assert found[900014] == ""


def test_language(spark, odd_dir, odd):
    found = rows(QUERIES["op6_language_id"](spark, odd_dir))
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, *_ in odd)
    texts = {i: (text, lang) for i, text, lang, _ in odd}
    right = []
    for r in found:
        if r["doc_id"] is None:  # two rows have none
            assert not r["held_out"]
            continue
        text, lang = texts[r["doc_id"]]
        held = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == held and 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif held and r["doc_id"] < 900000:
            right.append(r["lang_pred"] == lang)
    assert sum(right) >= 0.95 * len(right) > 20


def test_quality(spark, odd_dir, odd):
    found = rows(QUERIES["op7_line_quality"](spark, odd_dir))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    got = Counter((r["doc_id"], *(r[n] for n in names)) for r in found)
    assert got == Counter((i, *brute.quality(text)) for i, text, *_ in odd)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert kept[900006] and kept[900010] and not kept[900017]


def test_packing(spark, odd_dir, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = rows(QUERIES["op8_sequence_pack"](spark, odd_dir))
    wanted = Counter()
    for i, text, *_ in odd:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, low in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[low : low + 2048], "<u4")
            wanted[(i, p, low, len(part), zlib.crc32(part.tobytes()))] += 1
    names = "doc_id piece start length ids_crc32".split()
    assert Counter(tuple(r[n] for n in names) for r in found) == wanted
    check_sequences(found)


def check_sequences(found, slack=1.02):
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in found)
    assert len(by) <= slack * -(-total // 2048) + 1

"""op6 against a plain version: dictionaries of n-grams, one document after the other."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from crawlmart.llm import common, language
from crawlmart.llm.queries import QUERIES

MASK = (1 << 64) - 1


def scrambled(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def grams(text, buckets=1 << 16, orders=(1, 2, 3)):
    """Buckets of the n-grams of lower-cased letters with one space behind each word."""
    letters, out = [], []
    for c in text or "":
        if c.isalpha():
            low = c.lower()
            letters.append(ord(low) if len(low) == 1 else ord(c))
        elif letters and letters[-1] != 32:
            letters.append(32)
    salts = [scrambled(k + 1) | 1 for k in range(max(orders))]
    for k in orders:
        for i in range(len(letters) - k + 1):
            total = sum(x * s for x, s in zip(letters[i : i + k], salts, strict=False)) + k
            out.append(scrambled(total & MASK) % buckets)
    return out, sum(x != 32 for x in letters)


def brute(rows):
    held = {k: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1 for k, r in enumerate(rows)}
    seen, docs = {}, Counter()
    for k, (_, text, lang, _) in enumerate(rows):
        if not held[k] and lang is not None and text is not None:
            seen.setdefault(lang, Counter()).update(grams(text)[0])
            docs[lang] += 1
    names, buckets = sorted(seen), 1 << 16
    size = {x: sum(seen[x].values()) + 0.5 * buckets for x in names}
    out = []
    for k, (doc_id, text, _, _) in enumerate(rows):
        found, n_letters = grams(text)
        if not n_letters:
            out.append((doc_id, held[k], "und", 0.0))
            continue
        score = [
            math.log(docs[x] / sum(docs.values())) + sum(math.log((seen[x][g] + 0.5) / size[x]) for g in found)
            for x in names
        ]
        best = max(range(len(names)), key=score.__getitem__)
        out.append((doc_id, held[k], names[best], 1 / sum(math.exp(s - score[best]) for s in score)))
    return out


def test_languages_equal_the_plain_version(spark, odd_dir, odd):
    found = QUERIES["op6_language_id"](spark, odd_dir).collect()
    key = lambda r: (str(r[0]), r[2], round(r[3], 6))
    got = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in found), key=key)
    wanted = sorted(brute(odd), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in got], [r[3] for r in wanted], atol=1e-6)


@pytest.mark.parametrize("fan", [2, 64])
def test_counts_of_many_tasks_are_added_in_rounds(spark, monkeypatch, fan):
    monkeypatch.setattr(common, "FAN", fan)
    rows = [(f"some words of {'english' if k % 2 else 'deutsch'} {k}", "en" if k % 2 else "de") for k in range(90)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    one, many = language.train(docs.coalesce(1)), language.train(docs.repartition(13))
    assert one.languages == many.languages == ["de", "en"]
    assert np.array_equal(one.logs, many.logs) and np.array_equal(one.prior, many.prior)

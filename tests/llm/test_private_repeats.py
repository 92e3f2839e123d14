"""The skip-chain field: repeats that no pattern matches, and its inference."""

import itertools
import zlib

import numpy as np
import pytest

from crawlmart.llm import pii

SF = "/root/testdata/sf0.1"


def card(k):
    """A card number that passes the check digit."""
    digits = f"4{zlib.crc32(str(k).encode()):010d}{zlib.crc32(str(-k).encode()) % 10_000:04d}"
    return next(digits + str(c) for c in range(10) if pii.luhn(digits + str(c)))


def texts(share, n=400):
    """Documents with a matched card number, and it again: behind another number of 16 digits,
    which the pattern takes with it and drops, in a share of them, and matched in the others."""
    out = []
    for k in range(n):
        one = card(10**9 + 7919 * k)
        # 32 digits match no pattern; the first 16 alone would not pass the check either.
        other = str(int(card(10**10 + 104729 * k)) + 1)
        again = f"then {other} {one} once more" if k < share * n else f"then to {one} once more"
        out.append((k, f"order {k} room 12 paid with {one} on day {k % 28} of 2024, {again} for item {k % 90}"))
    return out


@pytest.mark.parametrize("share", [0.0, 0.02, 0.1, 0.5, 1.0])
def test_a_repeat_is_found_however_many_are_not_matched(spark, share):
    rows = texts(share)
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    _, text = texts(1.0, 1)[0]
    base, spans = pii.spans_of(text, model)
    one = card(10**9)
    assert [text[a:e] for a, _, e in base] == [one]
    assert one not in pii.redacted(text, spans)
    extra = [text[a:e] for a, _, e in spans if (a, e) not in {(x, z) for x, _, z in base}]
    assert extra == [one]  # and neither the other number nor the years, days and items


def test_other_repeated_numbers_are_none(spark):
    rows = [(k, t + f" part 77123456{k} and part 77123456{k} and 77123456{k}") for k, t in texts(0.1)]
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    for k, text in rows:
        base, spans = pii.spans_of(text, model)
        added = [text[a:e] for a, _, e in set(spans) - set(base)]
        assert all("771234" not in x for x in added), (k, added)


def test_redaction_of_the_document_with_a_hidden_repeat(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = pii.train(docs)
    text = docs.filter("doc_id = 46").first()["text"]
    assert text.count("4845168114407329") == 2
    assert "4845168114407329" not in pii.redacted(text, pii.spans_of(text, model)[1])


def exact(field, model):
    """Label probabilities by going through all labellings."""
    n = len(field.label)
    unary = model.weights[np.array(field.features)].sum(axis=1)
    unary -= np.logaddexp.reduce(unary, axis=1, keepdims=True)
    total = np.zeros((n, pii.N))
    allowed = [range(pii.N) if x < 0 else [x] for x in field.label]
    for labels in itertools.product(*allowed):
        score = sum(unary[i, x] for i, x in enumerate(labels) if field.label[i] < 0)
        score += sum(model.chain[labels[i], labels[j]] for i, j in field.chain)
        score += sum(model.skip[labels[i], labels[j]] for i, j in field.skip)
        for i, x in enumerate(labels):
            total[i, x] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def random_field(draw, n, loops):
    weights = draw.normal(0, 0.7, (pii.FEATURES, pii.N))
    both = [draw.normal(0, 0.6, (pii.N, pii.N)) for _ in range(2)]
    model = pii.Model(weights, *(x + x.T for x in both))
    tree = [(int(draw.integers(0, j)), j) for j in range(1, n)]
    chain, skip = tree[::2], tree[1::2]
    if loops:
        chain = [(i, i + 1) for i in range(n - 1)]
        skip = [(0, n - 1)] if n > 2 else []
    label = [int(draw.integers(1, pii.N)) if draw.random() < 0.3 else -1 for _ in range(n)]
    features = draw.integers(0, pii.FEATURES, (n, 3)).tolist()
    return pii.Field(list(range(n)), list(range(1, n + 1)), label, features, chain, skip), model


@pytest.mark.parametrize("n", [1, 2, 4, 6, 7])
def test_messages_are_exact_on_trees(n):
    draw = np.random.default_rng(n)
    for _ in range(6):
        field, model = random_field(draw, n, loops=False)
        assert np.allclose(pii.marginals(field, model, rounds=80), exact(field, model), atol=5e-3)


def test_messages_are_near_on_a_loop():
    draw = np.random.default_rng(77)
    for _ in range(6):
        field, model = random_field(draw, 5, loops=True)
        found, wanted = pii.marginals(field, model, rounds=80), exact(field, model)
        assert np.abs(found - wanted).max() < 0.12


def test_strips_change_nothing(monkeypatch):
    draw = np.random.default_rng(5)
    field, model = random_field(draw, 8, loops=True)
    whole = pii.marginals(field, model)
    monkeypatch.setattr(pii, "STRIP", 2)
    assert np.allclose(pii.marginals(field, model), whole)


def test_many_tokens_are_bounded():
    n = 120_000
    draw = np.random.default_rng(1)
    _, model = random_field(draw, 3, loops=True)
    features = draw.integers(0, pii.FEATURES, (n, 9)).tolist()
    chain = [(i, i + 1) for i in range(n - 1)]
    field = pii.Field(list(range(n)), list(range(n)), [1] + [-1] * (n - 1), features, chain, [(0, n - 1)])
    assert pii.marginals(field, model, rounds=3).shape == (n, pii.N)

"""Runs of very many sets in the n-gram Jaccard join: blocks against all pairs."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from crawlmart.llm import jaccard  # noqa: E402

SCHEMA = "run long, c long, n long, place long, root long"


def run_rows(seed):
    """A run of 300 sets of like and unlike sizes, one of a size, one component, short ones."""
    rng = np.random.default_rng(seed)
    out = []
    for run, k, roots in ((1, 300, 40), (2, 80, 1), (3, 9, 4), (4, 70, 70), (5, 1, 1)):
        for c in rng.choice(10_000, k, replace=False).tolist():
            n = 50 if run == 4 else int(rng.integers(1, 400))
            place = int(rng.integers(0, n // 4 + 1))
            out.append((run, c + 10_000 * run, n, place, int(rng.integers(0, roots))))
    return out


def all_pairs(rows, join):
    found = set()
    for r, c, n, place, root in rows:
        for r2, c2, n2, place2, root2 in rows:
            if r == r2 and c < c2 and root != root2:
                fits = join.den * min(n, n2) >= join.num * max(n, n2)
                if fits and min(n - place, n2 - place2) >= join.overlap(n + n2):
                    found.add((c, c2))
    return found


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 11])
def test_blocks_give_the_pairs_of_whole_runs(spark, block):
    rows, join = run_rows(block), jaccard.Join(block=block)
    runs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = [(r["a"], r["b"]) for r in jaccard.cross_pairs(runs, 3, join).collect()]
    assert len(found) == len(set(found))
    assert set(found) == all_pairs(rows, join)


def test_no_task_holds_more_than_two_blocks(spark):
    """One run with all rows: cells are bounded and rows of far sizes do not meet."""
    rows = [(1, c, 40 if c % 2 else 4000, 0, c) for c in range(1, 2001)]
    join = jaccard.Join(block=100)
    cells = jaccard._cells(spark.createDataFrame(rows, SCHEMA), join).collect()
    sizes, held = {}, {}
    for r in cells:
        sizes[r["x"], r["y"]] = sizes.get((r["x"], r["y"]), 0) + 1
        held.setdefault((r["x"], r["y"]), set()).add(r["n"])
    assert max(sizes.values()) < 4 * join.block  # hashes fill blocks about evenly
    assert all(len(n) == 1 for n in held.values())
    assert len(sizes) == 2 * (10 * 11 // 2)


def test_no_runs(spark):
    for join in (jaccard.Join(), jaccard.Join(block=1), jaccard.Join(num=100)):
        assert not jaccard.cross_pairs(spark.createDataFrame([], SCHEMA), 1, join).collect()


@pytest.mark.parametrize("num", [75, 100])
def test_documents_of_few_shared_passages(spark, num):
    """Documents put together from a stock of passages, in different orders, with a word of
    their own: their shingles are all frequent, so runs are long and few pairs are links."""
    rng = np.random.default_rng(3)
    stock = [" ".join(f"w{rng.integers(0, 10**6)}" for _ in range(12)) for _ in range(12)]
    docs = []
    for i in range(260):
        picked = rng.choice(12, int(rng.integers(2, 7)), replace=False)
        docs.append((i, " ".join(stock[p] for p in picked) + f" end{i % 40}"))
    docs += [(300, None), (301, " "), (302, "few words"), (303, "Few  words")]
    join = jaccard.Join(num=num, block=16)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard.linked_components(frame, join).collect()}
    sets = {i: brute.shingles(t) for i, t in docs}
    component = {i: i for i in sets}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                component[y] = x
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}

"""Near copies of short and very long texts against brute force, and how many candidates there are."""

from collections import Counter

import numpy as np

from cellweft.llm import shingle_join

from test_llm import brute_classes


def corpus(seed=4):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(4000)])
    texts = []
    for size in (3, 4, 5, 6, 8, 12, 20, 40, 80, 150, 300, 700, 1500, 3000):
        for _ in range(3):
            base = rng.choice(vocabulary, size)
            texts.append(base)
            for share in (0.002, 0.01, 0.02, 0.04, 0.06):
                other = base.copy()
                at = rng.random(size) < share
                other[at] = rng.choice(vocabulary, at.sum())
                texts += [other, np.delete(other, rng.integers(0, size))]
    passage = rng.choice(vocabulary, 50)  # many texts share it, none of them is a copy
    texts += [np.r_[rng.choice(vocabulary, n), passage, rng.choice(vocabulary, n)] for n in (5, 20, 60, 200) for _ in range(15)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n, share in ((5, (4, 5)), (3, (90, 100)), (5, (1, 2))):
        got = shingle_join.jaccard_classes(docs, n, share).collect()
        assert sorted(map(tuple, got), key=str) == brute_classes(rows, n, *share)
    assert len({c for _, _, c in brute_classes(rows, 5, 4, 5)}) < len(rows) - 50


def test_blocks_by_size(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_HASHES", 5000)
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, shingle_join.jaccard_classes(docs).collect()), key=str) == brute_classes(rows, 5, 4, 5)


def clusters(sets, share):
    """Sizes of the clusters that shared keys chain together."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    first = {}
    for i, s in enumerate(sets):
        for k in shingle_join.part_keys(s, share).tolist():
            root[find(i)] = find(first.setdefault(k, i))
    return Counter(find(i) for i in range(len(sets)))


def test_unlike_texts_share_no_key():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in rng.integers(1, 2000, 1500)]
    for share in ((4, 5), (90, 100)):
        assert max(clusters(sets, share).values()) == 1


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 1 << 63, n, np.uint64)
        gone, new = int(rng.integers(0, n // 4 + 1)), int(rng.integers(0, n // 4 + 2))
        b = np.unique(np.r_[a[gone:], rng.integers(0, 1 << 63, new, np.uint64)])
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 5 * both >= 4 * (len(a) + len(b) - both):
            assert set(shingle_join.part_keys(a, (4, 5)).tolist()) & set(shingle_join.part_keys(b, (4, 5)).tolist())


def test_dealing_by_size(spark):
    """Classes that may link meet in a pair of blocks; most pairs of blocks are never made."""
    rng = np.random.default_rng(3)
    sizes = np.r_[np.full(400, 50), rng.integers(1, 3000, 1600)]
    placed = spark.createDataFrame([(int(i % 2), int(n)) for i, n in enumerate(sizes)], "component long, size long")
    dealt = {(r["component"], r["size"]): r for r in shingle_join.deal(placed, (4, 5), 32).collect()}
    blocks = lambda r: range(r["before_cost"] // 32, (r["before_cost"] + r["n"] * r["cost"] - 1) // 32 + 1)
    sent = 0
    for (c, a), x in dealt.items():
        assert x["near"] <= min(blocks(x)) and max(blocks(x)) <= x["far"]
        sent += x["n"] * (x["far"] - x["near"] + 1)
        for (d, b), y in dealt.items():
            if c == d and 4 * max(a, b) <= 5 * min(a, b):
                assert set(blocks(y)) <= set(range(x["near"], x["far"] + 1))
    assert sent < 0.5 * len(sizes) * max(r["far"] + 1 for r in dealt.values())

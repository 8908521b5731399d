"""Near copies by their rarest n-grams: every link is found, and common passages make no candidates."""

import numpy as np

from cellweft.llm import shingle_join

from test_llm import brute_classes
from test_near_copies import corpus


def test_against_brute_force(spark, monkeypatch):
    rows = corpus(6)
    docs = spark.createDataFrame(rows + rows[:9] + [(None, "a b c"), (9001, None), (9002, "")], "doc_id long, text string")
    want = brute_classes(rows, 5, 4, 5)
    monkeypatch.setattr(shingle_join, "CELLS", 1 << 12)  # crowded cells
    got = shingle_join.jaccard_rows(docs, 5, (4, 5), rare=True).where("doc_id < 9000").select(
        "doc_id", "n_shingles", "component_id").distinct().collect()
    assert sorted(map(tuple, got), key=str) == want


def test_passages_make_no_candidates(spark, monkeypatch):
    rng = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(60)]
    own = lambda k: [f"w{rng.integers(10 ** 9)}" for _ in range(k)]
    texts = [own(k) + passage + own(90) for k in range(90, 130)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000, " ".join(texts[0][:-1]))]
    seen = []
    deal = shingle_join.deal

    def spy(placed, share, block):
        seen.append(placed.count())
        return deal(placed, share, block)

    monkeypatch.setattr(shingle_join, "deal", spy)
    kept = shingle_join.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, (4, 5))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    assert seen == [2]

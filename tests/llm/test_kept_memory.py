"""What a worker process keeps from one list of texts to the next is bounded, however many words the list had."""

import gc
import tracemalloc

import numpy as np
import public_tokenizers

from cellweft.llm import packing
from cellweft.llm import toxicity as T

LETTERS = "abcdefghij"


def distinct(n: int, first: int = 0) -> list[str]:
    return ["".join(LETTERS[int(d)] for d in f"{i:07d}") for i in range(first, first + n)]


def test_encoder_keeps_a_bounded_number_and_right_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 2000)
    ids = packing.encoder.__wrapped__(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(distinct(500, 500 * i)) for i in range(60)]
    alone = [ids([t])[0].tolist() for t in texts]
    gc.collect()
    tracemalloc.start()
    try:
        together = [own.tolist() for own in ids(texts)]
        assert together == alone
        del together
        gc.collect()
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 1_500_000


def test_scorer_forgets_after_a_long_list(monkeypatch):
    monkeypatch.setattr(T, "KNOWN", 1000)
    texts = [" ".join(distinct(500, 500 * i)) for i in range(20)]
    model = T.start_model()
    scorer = T.Scorer(model)
    once = scorer(texts)
    assert len(scorer.lexicon) <= 1000 and len(scorer.pre["f"]) <= 1000
    assert np.allclose(scorer(texts), once, atol=1e-6)
    assert np.allclose(np.concatenate([T.Scorer(model)([t]) for t in texts]), once, atol=1e-6)

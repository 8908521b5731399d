"""Parts that bound what a task holds or sends, against the plain way."""

import numpy as np

from cellweft.llm import byte_bpe, shingle_join
from cellweft.llm.common import utf8


def test_sliced_ids_are_the_ids(monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE", 7)
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 20, 50)
    starts = np.cumsum(sizes) - sizes
    flat = rng.integers(0, 1000, int(sizes.sum())).astype("<i4")
    for n in (0, 1, 300):
        spots = rng.integers(0, 50, n)
        cuts = np.concatenate([[0], np.cumsum(sizes[spots])]).astype(np.int64)
        want = np.concatenate([flat[:0], *[flat[starts[s]:starts[s] + sizes[s]] for s in spots]])
        assert np.array_equal(byte_bpe.gathered(flat, starts, sizes, spots, cuts), want)


def test_sets_of_sent_texts():
    for text in ("", "One two", "a b c d e f g a b c d", "Ü \ud800 X y z w"):
        assert np.array_equal(shingle_join.shingles(utf8(text), 3), shingle_join.shingles(text, 3))

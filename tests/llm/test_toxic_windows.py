"""Windows of the toxicity scorer, and its results on awkward rows."""

import numpy as np
import pytest

from cellweft.llm import toxicity as T


def test_windows_cover_every_run_of_words():
    for n in range(1, 200):
        starts = T.windows_of(n)
        assert starts[0] == 0 and starts[-1] + T.WINDOW >= n
        assert (np.diff(starts) == T.STEP).all() and 2 * T.STEP <= T.WINDOW
        for at in range(n - T.STEP):  # STEP + 1 words from here lie whole in one window
            assert any(s <= at and at + T.STEP + 1 <= s + T.WINDOW for s in starts)


def test_long_words_are_read_whole():
    head, tail = b"x" * 60, b"y" * 60
    one, two = (head + t for t in (tail, b"z" * 60))
    assert T.units_of("short words") == [b"short", b"words"]
    pieces = T.units_of(one.decode())
    assert pieces[0] == one[:T.LETTERS] and pieces[-1].endswith(b"y")
    for at in range(len(one) - T.LETTERS // 2):  # every half piece is whole in some piece
        assert any(one[at:at + T.LETTERS // 2] in p for p in pieces)
    assert not (np.array(T.word_codes(T.units_of(one.decode()))[-1]) == T.word_codes(T.units_of(two.decode()))[-1]).all()


def test_learns_a_word_deep_in_long_texts():
    rng = np.random.default_rng(0)
    texts, y = [], []
    for i in range(240):
        words = rng.choice([f"w{k}" for k in range(300)], 150).astype(object)
        if i % 4 == 0:
            words[rng.integers(0, 150)] = "vileword"
        texts.append(" ".join(words))
        y.append(float(i % 4 == 0))
    scores = T.Scorer(T.fit(texts[:160], np.array(y[:160])))(texts[160:])
    assert ((scores >= T.THRESHOLD) == (np.array(y[160:]) == 1)).mean() > 0.95


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, "bad words"), (3, "bad words"), (None, "good words"), (5, "x" * 5000), (6, "good words " * 4000)]
    return spark.createDataFrame([(i, t, 0.5, True) for i, t in rows], "doc_id long, text string, score double, held_out boolean")


def test_awkward_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1), (3, 1), (6, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    got = T.toxicity_scores(odd, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "3", "3", "5", "6", "None"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= T.THRESHOLD) for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (1, 2)]
    assert empty[0] == empty[1]
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    assert [r["score"] for r in T.toxicity_scores(odd, labels.limit(0)).collect()] == [0.0] * 7
    assert T.toxicity_scores(odd.limit(0), labels).count() == 0
    assert T.keep_clean(odd, labels.limit(0)).columns == odd.columns

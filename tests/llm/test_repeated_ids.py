"""Rows that share a doc_id: other texts stay apart, exact repeats are one."""

import corpus_pipeline
from cellweft.llm import shingle_join

from test_llm import brute_classes


def words(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


# Longest first and last, so that a lost set would lose a link whichever of the two is kept.
ROWS = [(1, words("a")), (1, words("b")), (2, words("a") + " end"), (3, words("b") + " end"), (4, words("c")), (4, words("c")),
        (2, words("d")), (None, words("a")), (5, ""), (5, ""), (6, None)]


def test_classes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for block in (1, 2048):
        got = shingle_join.jaccard_classes(docs, 3, (90, 100), block).collect()
        assert sorted(map(tuple, got), key=str) == brute_classes(ROWS, 3, 90, 100)


def test_stage(spark):
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(ROWS)],
                                 "doc_id long, text string, copy string, node int")
    got = corpus_pipeline.distinct(spark, docs, "")
    assert got.columns == docs.columns
    want = [r for k, r in enumerate(ROWS) if k not in (2, 3, 5)]
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=str) == sorted(want, key=str)
    assert corpus_pipeline.distinct(spark, docs.limit(0), "").count() == 0

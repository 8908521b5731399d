"""Tasks of op1."""

import numpy as np

from cellweft.llm import exact_topk

RNG = np.random.default_rng(12)


def test_many_shards_and_blocks_in_few_tasks(spark, monkeypatch):
    """Tasks of op1 do not grow with shards times blocks, and no matrix is broadcast."""
    asked = []
    kind = type(spark.range(1))
    right = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *c: asked.append(n) or right(self, n, *c))
    monkeypatch.setattr(exact_topk, "TASKS", 20, raising=False)
    monkeypatch.setattr(exact_topk, "VISITORS", 4, raising=False)
    v = RNG.integers(-9, 9, (120, 3)).astype(float)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<double>")
    got = exact_topk.exact_topk(df, df.where("vec_id % 2 = 0"), 4, shard=8, block=5).orderBy("query_id", "rank").collect()
    score = (v @ v.T).astype(int)
    want = [(q, r + 1, i, score[q, i]) for q in range(0, 120, 2)
            for r, i in enumerate(sorted((i for i in range(120) if i != q), key=lambda i: (-score[q, i], i))[:4])]
    assert [tuple(r) for r in got] == want
    assert asked and max(asked) <= 20

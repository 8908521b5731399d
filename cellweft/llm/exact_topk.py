"""Exact inner-product search: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards of a bounded size; each shard is one row, whose ball tree is built where it meets queries. Queries
come in blocks. Every block first searches one shard; the scores it finds bound its k-th scores from below and go with the
block to all other shards, where nodes are visited by falling upper bound (centre score + query norm * radius) and left once
the bound is below the k-th score of every query of the block that is still open. A shard is sent once for every VISITORS
blocks; neither shards nor blocks are broadcast, and the number of tasks is bounded, so many vectors do not fill the driver.
A query's k best of all shards are merged by a window. Scores are exact integers: products are taken in double precision
where they provably fit below 2**53, in Python integers elsewhere.

Vectors without an id, null, empty, or with null or non-finite components take no part, neither do vectors whose
dimension differs from the query's, nor integers beyond 2**62. Ties go to the smaller vec_id; repeated rows count
each; a query never meets rows of its own id. Fewer candidates than k give fewer rows, an empty table none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.llm.common import table
from cellweft.llm.registry import query
from cellweft.llm.vectors import blocks, matrix, valid
from cellweft.session import settle

SHARD = 4096       # vectors of a shard
QUERIES_BLOCK = 1024
VISITORS = 64      # blocks of queries that a shard meets at once
TASKS = 2000       # of one search, at most
LEAF = 64
HITS = "query_id long, vec_id long, score long"


def ball_tree(x: np.ndarray, leaf: int = LEAF) -> list[tuple[np.ndarray, float, np.ndarray | None, int, int]]:
    """Nodes (centre, radius, rows of a leaf, left, right); node 0 is the root."""
    nodes: list = []

    def build(rows: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(None)
        own = x[rows]
        centre = own.mean(0)
        gaps = np.sqrt(((own - centre) ** 2).sum(1))
        radius = float(gaps.max())
        if len(rows) <= leaf or radius == 0:
            nodes[at] = (centre, radius, rows, -1, -1)
            return at
        a = own[gaps.argmax()]
        b = own[((own - a) ** 2).sum(1).argmax()]
        side = own @ (b - a)
        order = side.argsort(kind="stable")
        half = len(rows) // 2
        left, right = build(rows[order[:half]]), build(rows[order[half:]])
        nodes[at] = (centre, radius, None, left, right)
        return at

    build(np.arange(len(x)))
    return nodes


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2 ** 53:
        return np.rint(q @ x.T).astype(np.int64)
    exact = q.astype(np.int64).astype(object) @ x.astype(np.int64).astype(object).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def search(nodes, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
    """Best k of the shard per query, as far as they reach ``floor``: rows (query, vec_id, score)."""
    norms = np.sqrt((q ** 2).sum(1))
    kth = floor.astype(float).copy()
    best: list[list[tuple[int, int]]] = [[] for _ in qids]
    slack = 1e-6

    def upper(node: int, open_: np.ndarray) -> np.ndarray:
        centre, radius = nodes[node][:2]
        bound = q[open_] @ centre + norms[open_] * radius
        return bound + slack * (1 + np.abs(bound))

    first = np.arange(len(qids))
    heap = [(-float(upper(0, first).max(initial=-np.inf)), 0, first, upper(0, first))]
    while heap:
        _, node, open_, bound = heapq.heappop(heap)
        open_ = open_[bound >= kth[open_]]
        if not len(open_):
            continue
        rows, left, right = nodes[node][2:]
        if rows is None:
            for child in (left, right):
                b = upper(child, open_)
                keep = b >= kth[open_]
                if keep.any():
                    heapq.heappush(heap, (-float(b[keep].max()), child, open_[keep], b[keep]))
            continue
        scores = products(q[open_], x[rows])
        for i, s in zip(open_, scores):
            fit = np.flatnonzero((s >= kth[i]) & (ids[rows] != qids[i]))
            if len(fit):
                own = np.lexsort((ids[rows][fit], -s[fit]))[:k]
                best[i] = sorted(best[i] + [(-int(s[j]), int(ids[rows[j]])) for j in fit[own]])[:k]
                if len(best[i]) == k:
                    kth[i] = max(kth[i], float(-best[i][-1][0]))
    return [(int(qids[i]), v, -s) for i, found in enumerate(best) for s, v in found]


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int, shard: int = SHARD,
               block: int = QUERIES_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs have vec_id and v (integers held as doubles)."""
    fits = ~F.exists("v", lambda x: F.abs(x) >= 2.0 ** 62)
    rows = settle(candidates.where(fits).withColumn("dim", F.size("v")), "topk_rows")
    asked = settle(queries.where(fits).withColumn("dim", F.size("v")), "topk_asked")
    n, m = max(1, -(-rows.count() // shard)), max(1, -(-asked.count() // block))
    mixed = F.xxhash64("vec_id", F.monotonically_increasing_id())
    shards = settle(blocks(rows.withColumn("shard", F.pmod(mixed, F.lit(n)).cast("int")), ["dim", "shard"], shard), "shards")
    wanted = blocks(asked.withColumn("part", F.pmod(mixed, F.lit(m)).cast("int")), ["dim", "part"], block).select(
        "dim", "part", F.col("ids").alias("qids"), F.col("data").alias("qdata"))
    wanted = settle(wanted, "topk_queries")

    def visit(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        trees = []
        if not len(asking):
            own = own.iloc[:0]
        for row in own.itertuples(index=False):
            ids, x = matrix(row.ids, row.data)
            trees.append((ball_tree(x), ids, x))
        for row in asking.itertuples(index=False):
            qids, q = matrix(row.qids, row.qdata)
            floor = np.full(len(qids), -np.inf)
            if row.floors is not None:
                known = dict(zip(np.asarray(row.floor_ids).tolist(), np.asarray(row.floors).tolist()))
                floor = np.array([known.get(int(i), -np.inf) for i in qids], float)
            for tree, ids, x in trees:
                found += search(tree, ids, x, qids, q, floor, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    groups = -(-m // VISITORS)

    def met(asking: DataFrame, most: int, tasks: int) -> DataFrame:
        """Hits of blocks in the shards they are sent to, which are below ``most``."""
        keys = ["dim", "shard", "visitors"]
        asking = asking.withColumn("visitors", F.floor(F.col("part") / VISITORS).cast("int")).drop("part")
        own = shards.where(F.col("shard") < most).select("dim", "shard", "ids", "data", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("visitors"))
        tasks = max(1, min(tasks, TASKS))
        return own.repartition(tasks, *keys).groupBy(*keys).cogroup(asking.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(
            visit, HITS)

    # The first shard of each block, its k-th scores, then all other shards under them.
    home = F.pmod(F.col("part"), F.lit(n)).cast("int")
    none = [F.lit(None).cast("array<long>").alias("floor_ids"), F.lit(None).cast("array<long>").alias("floors")]
    first = settle(met(wanted.select("dim", home.alias("shard"), "part", "qids", "qdata", *none), min(n, m), m), "topk_first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("kth")).where(F.col("c") >= k)
    # Floors of a dimension's queries, at most one number a query of the block.
    parts = wanted.select("dim", "part", "qids").mapInPandas(
        lambda it: (pd.DataFrame({"dim": r.dim, "part": r.part, "query_id": np.unique(np.frombuffer(r.qids, "<i8"))})
                    for b in it for r in b.itertuples(index=False)), "dim int, part int, query_id long")
    floors = parts.join(kth, "query_id").groupBy("dim", "part").agg(
        F.collect_list("query_id").alias("floor_ids"), F.collect_list("kth").alias("floors"))
    rest = wanted.hint("merge").join(floors, ["dim", "part"], "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).where(F.col("shard") != home).select(
        "dim", "shard", "part", "qids", "qdata", "floor_ids", "floors")
    later = settle(met(rest, n, n * groups), "topk_later")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.unionByName(later).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SQL = """with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v))
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) t where rank <= 10"""


@query("op1_exact_topk", SQL)
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(table(spark, sf_dir, "embeddings")).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * 1024.0).cast("double")).alias("v"))
    return exact_topk(rows, rows.where("vec_id % 100 = 0"), 10)

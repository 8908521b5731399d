"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample; their number follows the table's size up to MAX_LISTS. Every vector goes to
its nearest centroid's list and, near a boundary, to the other lists whose distance is within SPREAD of the nearest
(at most COPIES). Lists are cut into parts of a bounded size, so a hot list is spread over tasks and still searched
whole. Centroids are found through an in-memory neighbour graph by best-first search; a query reads the lists whose
distance is within PRUNE of its nearest, and on until these hold more than k vectors of their own. Scores are exact
cosines of the original vectors in double precision.

Vectors without an id, null, empty, zero, or with null or non-finite components take no part, nor do those of another
dimension than the query's. Ties go to the smaller vec_id; a query never meets rows of its own id. Rows repeated
in full count once. An empty table gives no rows; fewer candidates than k give fewer rows.
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

SAMPLE = 20_000     # rows that centroids are fitted on, at most
MAX_LISTS = 1024
PER_LIST = 400
PART = 4096         # vectors of one part of a list
COPIES = 3
SPREAD = 1.04
PRUNE = 1.25
DEGREE = 16
EF = 64


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Centroids of unit vectors; an empty one restarts at the point worst served."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = x @ c.T
        own, worst = near.argmax(1), iter(near.max(1).argsort())
        for j in range(len(c)):
            member = own == j
            c[j] = x[member].mean(0) if member.any() else x[next(worst)]
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def graph(c: np.ndarray, degree: int = DEGREE) -> list[np.ndarray]:
    """Each centroid's nearest others, made mutual, along with a ring that keeps the graph connected."""
    n = len(c)
    links: list[set[int]] = [set() for _ in range(n)]
    near = np.argsort(-(c @ c.T), axis=1, kind="stable")[:, :degree + 1]
    for i in range(n):
        for j in [*near[i], (i + 1) % n]:
            if i != j:
                links[i].add(int(j))
                links[int(j)].add(i)
    return [np.array(sorted(s), int) for s in links]


def nearest_lists(q: np.ndarray, c: np.ndarray, links: list[np.ndarray], ef: int = EF) -> list[tuple[float, int]]:
    """(distance, list), nearest first: best-first search over the graph from a few fixed entries."""
    starts = np.unique(np.linspace(0, len(c) - 1, 8).astype(int))
    gaps = np.sqrt(np.maximum(0, 2 - 2 * (c[starts] @ q)))
    seen = set(starts.tolist())
    todo = [(float(g), int(i)) for g, i in zip(gaps, starts)]
    heapq.heapify(todo)
    best = sorted(todo)
    while todo:
        g, i = heapq.heappop(todo)
        if len(best) >= ef and g > best[ef - 1][0]:
            break
        fresh = np.array([j for j in links[i] if int(j) not in seen], int)
        if len(fresh):
            seen.update(fresh.tolist())
            more = [(float(x), int(j)) for x, j in zip(np.sqrt(np.maximum(0, 2 - 2 * (c[fresh] @ q))), fresh)]
            for pair in more:
                heapq.heappush(todo, pair)
            best = sorted(best + more)[:max(ef, 1)]
    return best


def search_lists(candidates: DataFrame, queries: DataFrame, k: int, prune: float = PRUNE) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs have vec_id and v (doubles)."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = settle(candidates.withColumn("norm", norm).where("norm > 0 and norm < double('inf')"), "ann_rows")
    asked = queries.withColumn("norm", norm).where("norm > 0 and norm < double('inf')")
    out = None
    for (dim,) in rows.select(F.size("v").alias("d")).distinct().orderBy("d").collect():  # as a rule one
        found = search_dim(rows.where(F.size("v") == dim), asked.where(F.size("v") == dim), k, prune)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else rows.sparkSession.createDataFrame(
        [], "query_id long, rank int, vec_id long, score double")


def search_dim(rows: DataFrame, asked: DataFrame, k: int, prune: float) -> DataFrame:
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    unit = np.array(sample.tolist(), float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    centres = kmeans(unit, int(np.clip(total // PER_LIST, 1, MAX_LISTS)))
    links = graph(centres)

    def assign(batches):
        for b in batches:
            x = np.array(b["v"].tolist(), float).reshape(len(b), -1)
            x /= b["norm"].to_numpy()[:, None]
            for v, name, own in zip(b["v"], b["vec_id"], x):
                best = nearest_lists(own, centres, links, 16)[:COPIES]
                keep = [j for g, j in best if g <= best[0][0] * SPREAD]
                yield pd.DataFrame({"list": keep, "first": [i == 0 for i in range(len(keep))], "vec_id": name,
                                    "v": [v] * len(keep)})

    def batched(batches):
        rows_: list = []
        for frame in assign(batches):
            rows_.append(frame)
            if len(rows_) >= 2000:
                yield pd.concat(rows_)
                rows_ = []
        if rows_:
            yield pd.concat(rows_)

    posted = settle(rows.mapInPandas(batched, "list int, first boolean, vec_id long, v array<double>"), "ann_posted")
    sizes = {r[0]: (int(r[1]), int(r[2])) for r in posted.groupBy("list").agg(
        F.count("*"), F.sum(F.col("first").cast("int"))).collect()}  # one row a list
    n_parts = {i: -(-n // PART) for i, (n, _) in sizes.items()}
    spread = F.create_map(*[F.lit(x) for i, n in n_parts.items() for x in (i, n)])
    part = F.pmod(F.xxhash64("vec_id"), spread[F.col("list")]).cast("int")
    stored = settle(blocks(posted.select("list", "vec_id", "v", part.alias("part")), ["list", "part"], PART), "ann_lists")

    def choose(batches):
        for b in batches:
            out = []
            for name, v, size in zip(b["vec_id"], b["v"], b["norm"]):
                q, own = np.asarray(v, float), 0
                best = nearest_lists(q / size, centres, links)
                if sum(sizes.get(j, (0, 0))[1] for _, j in best) <= k:
                    best = nearest_lists(q / size, centres, links, len(centres))
                for g, j in best:
                    if g > prune * best[0][0] and own > k:
                        break
                    own += sizes.get(j, (0, 0))[1]
                    out += [(j, p, name, v) for p in range(n_parts.get(j, 0))]
            yield pd.DataFrame(out, columns=["list", "part", "query_id", "q"])

    reads = asked.mapInPandas(choose, "list int, part int, query_id long, q array<double>")

    def look(batches):
        for b in batches:
            for (_, _), own in b.groupby(["list", "part"], sort=False):
                ids, x = matrix(own["ids"].iloc[0], own["data"].iloc[0])
                lengths = np.sqrt((x ** 2).sum(1))
                q = np.array(own["q"].tolist(), float)
                hits = []
                for name, one in zip(own["query_id"], q):
                    score = (x * one).sum(1) / (lengths * np.sqrt((one ** 2).sum()))
                    score[ids == name] = -np.inf
                    best = np.lexsort((ids, -score))[:k]
                    hits += [(name, int(ids[i]), float(score[i])) for i in best if score[i] > -np.inf]
                yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    # Few queries to a row, so that a list's block is not repeated for each of them.
    grouped = reads.withColumn("slot", F.pmod(F.xxhash64("query_id"), F.lit(16))).groupBy("list", "part", "slot").agg(
        F.collect_list(F.struct("query_id", "q")).alias("asked"))

    def look_many(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                own = pd.DataFrame({"list": row.list, "part": row.part, "ids": [row.ids] * len(row.asked),
                                    "data": [row.data] * len(row.asked), "query_id": [a["query_id"] for a in row.asked],
                                    "q": [a["q"] for a in row.asked]})
                yield from look([own])

    hits = grouped.join(stored, ["list", "part"]).mapInPandas(look_many, "query_id long, vec_id long, score double")
    # A replicated vector is found more than once.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


@query("op4_ann_lists")
def op4_ann_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(table(spark, sf_dir, "embeddings"))
    return search_lists(rows, rows.where("vec_id % 50 = 0"), 5)

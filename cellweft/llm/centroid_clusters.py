"""Centroid clustering in exact integers, with centroids ruled out by rotated coordinates.

Vectors become integers floor(scale * x). They are stored once, in blocks of rows: the integers, their leading coordinates
after a rotation to the principal axes, and the norm of the rest (the residual). For a vector and a centroid, the squared
distance of the leading coordinates plus the squared difference of the residual norms never exceeds the squared distance,
so a round verifies in integers only the centroids whose bound, less a margin for rounding, does not exceed the best exact
distance found. The rotation comes from the second moments of all vectors, summed by task and then by row of the matrix;
any rotation gives the same clusters, a good one fewer verifications.

Centroids are the only thing every task gets (k vectors; k is a parameter). A round returns, from each task, the counts and
component sums of its clusters; they are merged per cluster. Sums and distances are taken in 64-bit integers where
they provably fit and in Python's unbounded integers elsewhere.

Vectors null, of another length than ``dimension``, or with null or non-finite components take no part. A null vec_id is an
id like any other (seeded as the empty text); repeated rows count each, and rows with one id are ordered by their
components for the seeds. Fewer vectors than k give fewer centroids, an empty table no rows. Distances beyond 64 bits are
null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.llm.common import plain, table
from cellweft.llm.registry import query
from cellweft.session import col, settle

BLOCK = 1024       # vectors of a stored row
LEADING = 12       # rotated coordinates kept
SAFE = 1 << 27     # components up to this size: squares of differences of up to 128 components fit in 64 bits
MARGIN = 1e-9      # of the squared norms, far above the rounding of the bound
STORED = "ids binary, known binary, big boolean, data binary, leading binary, rest binary"


@dataclass
class Clusters:
    vectors: DataFrame     # vec_id, cluster, distance
    centroids: list[list[int]]
    sizes: DataFrame       # cluster, n, inertia


def kept(vectors: DataFrame, dimension: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    x = F.transform(F.col("e"), lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(col(vec_id).cast("long").alias("vec_id"), col(embedding).alias("e"))
    return rows.where(F.size("e") == dimension).select("vec_id", x.alias("x")).where(~bad)


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where all are small, else as Python integers."""
    # A double times a power of two is exact unless it leaves the range of doubles.
    if np.abs(x).max(initial=0) * scale <= SAFE:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[math.floor(scale * int(v)) if abs(v) >= 2 ** 53 else math.floor(scale * v) for v in row] for row in x],
                    object).reshape(x.shape)


def read(row, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """ids, integers of a stored row."""
    ids = np.frombuffer(row.ids, "<i8")
    if row.big:
        text = row.data.decode().split(",")
        return ids, np.array([int(v) for v in text], object).reshape(len(ids), dimension)
    return ids, np.frombuffer(row.data, "<i4").astype(np.int64).reshape(len(ids), dimension)


def second_moments(rows: DataFrame, dimension: int) -> np.ndarray:
    """Sum of x' x over all rows, with one more column of ones (sums and count), each task's part scaled alike."""
    size = dimension + 1

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for pdf in batches:
            if len(pdf):
                x = np.clip(np.array(pdf["x"].tolist(), float), -1e100, 1e100)
                x = np.hstack([x, np.ones((len(x), 1))])
                total += x.T @ x
        yield pd.DataFrame({"i": range(size), "m": [r.tobytes() for r in total]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"][:1], "m": [sum(np.frombuffer(m) for m in pdf["m"]).tobytes()]})

    found = rows.select("x").mapInPandas(part, "i int, m binary").groupBy("i").applyInPandas(merge, "i int, m binary").collect()
    out = np.zeros((size, size))
    for r in found:
        out[r.i] = np.frombuffer(r.m)
    return out


def rotation(moments: np.ndarray, leading: int) -> np.ndarray:
    """The ``leading`` principal axes as columns."""
    n = moments[-1, -1]
    if not n:
        return np.eye(len(moments) - 1)[:, :leading]
    mean = moments[-1, :-1] / n
    spread = np.nan_to_num(moments[:-1, :-1] / n - np.outer(mean, mean))
    top = np.abs(spread).max() or 1.0
    axes = np.linalg.eigh(spread / top)[1]
    return np.ascontiguousarray(axes[:, ::-1][:, :leading])


def rotated(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of what they leave."""
    x = x.astype(float)
    lead = x @ axes
    return lead, np.sqrt(((x - lead @ axes.T) ** 2).sum(1))


def store(rows: DataFrame, axes: np.ndarray, scale: int, block: int = BLOCK) -> DataFrame:
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), block):
                own = pdf.iloc[at:at + block]
                x = whole(np.array(own["x"].tolist(), float), scale)
                ids = own["vec_id"]
                big = x.dtype == object
                with np.errstate(all="ignore"):
                    lead, rest = (np.zeros((len(x), 0)), np.zeros(0)) if big else rotated(x, axes)
                yield pd.DataFrame([[ids.fillna(0).to_numpy("<i8").tobytes(), ids.notna().to_numpy().tobytes(), big,
                                     ",".join(map(str, x.ravel())).encode() if big else x.astype("<i4").tobytes(),
                                     lead.tobytes(), rest.tobytes()]],
                                   columns=["ids", "known", "big", "data", "leading", "rest"])
    return settle(rows.mapInPandas(write, STORED), "rotated")


def nearest(x: np.ndarray, centroids: np.ndarray, lead: np.ndarray, rest: np.ndarray, axes: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster, squared distance, and how many distances were taken; equal distances go to the smaller number.

    With an empty ``lead`` (integers beyond SAFE), or such centroids, all distances are taken, in Python's integers.
    """
    if not len(rest) or centroids.dtype == object:
        far = np.stack([((x.astype(object) - c.astype(object)) ** 2).sum(1) for c in centroids], 1)
        at = far.argmin(1)
        return at, far[np.arange(len(x)), at], far.size
    c_lead, c_rest = rotated(centroids, axes)
    bound = ((lead * lead).sum(1)[:, None] - 2 * lead @ c_lead.T + (c_lead * c_lead).sum(1)) + (rest[:, None] - c_rest) ** 2
    scale = ((lead * lead).sum(1) + rest * rest)[:, None] + ((c_lead * c_lead).sum(1) + c_rest ** 2)
    bound -= MARGIN * scale + MARGIN
    first = bound.argmin(1)
    best = ((x - centroids[first]) ** 2).sum(1)
    open_ = bound <= best[:, None]
    far = np.full(bound.shape, np.iinfo(np.int64).max)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero(open_[:, j])
        far[rows, j] = ((x[rows] - c) ** 2).sum(1)
    at = far.argmin(1)
    return at, far[np.arange(len(x)), at], len(x) + int(open_.sum())


def as_matrix(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(v) <= SAFE for c in centroids for v in c)
    return np.array(centroids, np.int64 if small else object)


def assign(stored: DataFrame, centroids: list[list[int]], axes: np.ndarray, dimension: int) -> DataFrame:
    """vec_id, cluster, distance."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = as_matrix(centroids)
        for pdf in batches:
            for row in pdf.itertuples():
                ids, x = read(row, dimension)
                lead = np.frombuffer(row.leading).reshape(len(ids), -1)
                at, far, _ = nearest(x, now, lead, np.frombuffer(row.rest), axes)
                known = np.frombuffer(row.known, bool)
                yield pd.DataFrame({"vec_id": pd.array(ids, "Int64").copy() if known.all() else pd.array(
                    [int(i) if k else None for i, k in zip(ids, known)], "Int64"), "cluster": at.astype(np.int32),
                    "distance": pd.array([int(d) if d < 2 ** 63 else None for d in far], "Int64")})
    return stored.mapInPandas(run, "vec_id long, cluster int, distance long")


def next_centroids(stored: DataFrame, centroids: list[list[int]], axes: np.ndarray, dimension: int) -> list[list[int]]:
    """Each centroid's componentwise floor of the mean of its vectors; one without vectors stays."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = as_matrix(centroids)
        counts, sums = [0] * len(now), [np.array([0] * dimension, object) for _ in now]
        for pdf in batches:
            for row in pdf.itertuples():
                _, x = read(row, dimension)
                lead = np.frombuffer(row.leading).reshape(len(x), -1)
                at = nearest(x, now, lead, np.frombuffer(row.rest), axes)[0]
                for j in np.unique(at):
                    own = x[at == j]
                    counts[j] += len(own)
                    sums[j] = sums[j] + own.sum(0).astype(object)
        yield pd.DataFrame([[j, n, ",".join(map(str, s))] for j, (n, s) in enumerate(zip(counts, sums)) if n],
                           columns=["cluster", "n", "sums"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.array([int(v) for v in s.split(",")], object) for s in pdf["sums"])
        n = int(pdf["n"].sum())
        return pd.DataFrame({"cluster": pdf["cluster"][:1], "mean": [",".join(str(v // n) for v in total)]})

    new = stored.mapInPandas(part, "cluster int, n long, sums string").groupBy("cluster").applyInPandas(
        merge, "cluster int, mean string").collect()
    out = list(centroids)
    for r in new:
        out[r.cluster] = [int(v) for v in r.mean.split(",")]
    return out


def seeds(rows: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(mark.alias("mark"), "x").orderBy("mark", "x").limit(k).collect()
    return [[int(v) for v in whole(np.array([r.x], float), scale)[0]] for r in first]


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dimension: int = 64, scale: int = 64, seed: int = 1,
            leading: int = LEADING) -> Clusters:
    rows = kept(vectors, dimension)
    centroids = seeds(rows, k, scale, seed)
    axes = rotation(second_moments(rows, dimension), min(leading, dimension))
    stored = store(rows, axes, scale)
    if centroids:
        for _ in range(rounds):
            centroids = next_centroids(stored, centroids, axes, dimension)
    found = settle(assign(stored, centroids, axes, dimension), "assigned")
    sizes = found.groupBy("cluster").agg(F.count("*").alias("n"), F.try_sum("distance").alias("inertia"))
    return Clusters(found, centroids, settle(sizes, "sizes"))


def digests(spark: SparkSession, centroids: list[list[int]]) -> DataFrame:
    rows = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, centroid_sha256 string")


def _sql(k: int = 16, rounds: int = 3) -> str:
    """The same in SQL: every round assigns by all distances and takes floors of means."""
    steps = [f"""v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as x
        from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), x) - 1 as c, x as m from v
    qualify c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as (select r, vec_id, x, c, d from (select r, vec_id, x, c, list_sum(list_transform(list_zip(x, m),
        lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from v, c{i}) qualify row_number() over (partition by r order by d, c) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} as (select c, j, sum(y)::bigint as s, count(*) as n from
        (select c, unnest(range(1, 65)) as j, unnest(x) as y from a{i}) group by c, j),
c{i + 1} as (select c, coalesce(list(((s - ((s % n) + n) % n) // n)::bigint order by j) filter (j is not null), any_value(m)) as m
    from c{i} left join s{i} using (c) group by c)""")
    return "with " + ",\n".join(steps) + f"""
select vec_id, a.c::int as cluster, d as distance, (sum(d) over (partition by a.c))::bigint as cluster_inertia,
    (sum(d) over ())::bigint as inertia, sha256(array_to_string(m, ',')) as centroid_sha256
from a{rounds} a join c{rounds} m on a.c = m.c"""


@query("op13_centroid_clusters", _sql())
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cluster(table(spark, sf_dir, "embeddings"))
    total = done.sizes.agg(F.try_sum("inertia").alias("inertia")).first()["inertia"]
    known = done.sizes.select("cluster", F.col("inertia").alias("cluster_inertia")).join(
        digests(spark, done.centroids), "cluster")
    # One row a centroid, sixteen at most.
    return done.vectors.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")

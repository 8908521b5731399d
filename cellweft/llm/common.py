"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.session import col, settle

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra ones with clashing names never meet the operator's own."""
    return df.select(*[col(n).alias(n) for n in names])


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def give_back() -> None:
    """At the end of a task: its worker process lives on, and Arrow's pool would keep what the task has freed."""
    pa.default_memory_pool().release_unused()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) of an undirected graph, by alternating stars.

    Each round hooks every node's larger neighbours, then its smaller ones, to its smallest neighbour;
    minima are pre-aggregated and the join back is an ordinary one that adaptive execution can split, so a
    node with very many neighbours does not land in one task. Every round is stored.
    """
    now = settle(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "cc")
    for i in range(2 * rounds):
        if i % 2 == 0:
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        linked = both.join(low, F.col("u") == F.col("k"))
        if i % 2 == 0:
            nxt = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            nxt = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        nxt = settle(nxt.where("u <> v").distinct(), "cc")
        if i % 2:
            # A forest of stars: no centre hangs on another node, and each node hangs on one centre.
            tops = nxt.select(F.col("v").alias("u")).distinct()
            stacked = nxt.select("u").distinct().join(tops, "u", "left_semi").limit(1).count()
            forked = nxt.groupBy("u").count().where("count > 1").limit(1).count()
            if not stacked and not forked:
                centres = nxt.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
                return nxt.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
        now = nxt
    raise RuntimeError("components did not settle")

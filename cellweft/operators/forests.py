"""Forests fitted on all rows from the counts of equal binned rows.

A forest sees a row by the bins of its features, its label and its weight only, so rows that agree in them are one entry
with a count. Spark counts the entries in one pass; tasks then grow ranges of trees from them with the search's own
``grid.grow``: bootstraps draw rows, not entries, and leaves count rows. The fit's time depends on the entries, not on the rows.
Where there are more than ENTRY_LIMIT entries (many features), ``fit`` gives None and Spark's forest takes the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.operators import grid
from cellweft.session import col, settle

ENTRY_LIMIT = 100_000
KNOWN = 500_000  # cells whose probability a task keeps
PART = "first int, trees int, ends array<int>, feature array<int>, bin array<int>, child array<int>, value array<double>"


@dataclass
class ForestModel:
    """``prepare`` fills and bins the features; a row of ``parts`` holds a range of trees, level by level."""
    prepare: PipelineModel
    features: list[str]
    parts: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` (int) and ``probability`` (double, class 1)."""
        parts = df.sparkSession.sparkContext.broadcast([unpacked(r) for r in self.parts.orderBy("first").collect()])
        known: dict[bytes, float] = {}

        def score(cells: pd.DataFrame) -> pd.Series:
            bins = np.ascontiguousarray(cells.to_numpy().astype(np.uint8))
            first, at, _ = grid.same([bins])
            names = [bins[i].tobytes() for i in first]
            if len(known) > KNOWN:
                known.clear()
            new = [i for i, name in enumerate(names) if name not in known]
            if new:
                own = bins[first[new]]
                total = sum(walk(levels, trees, own) for trees, levels in parts.value) / sum(t for t, _ in parts.value)
                known.update(zip([names[i] for i in new], total.tolist()))
            return pd.Series(np.array([known[n] for n in names])[at] if len(names) else [], dtype=float)

        binned = self.prepare.transform(df).select(*[col(c) for c in df.columns], F.struct(
            *[col(binned_name(f)) for f in self.features]).alias("__cell"))
        scored = binned.withColumn("probability", F.pandas_udf(score, "double")("__cell")) if "probability" not in df.columns \
            else binned.withColumn("__s", F.pandas_udf(score, "double")("__cell")).drop("probability").withColumnRenamed("__s", "probability")
        return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int")).select(
            *[col(c) for c in df.columns if c not in ("prediction", "probability")], "prediction", "probability")

    def save(self, path: str) -> None:
        self.prepare.write().overwrite().save(f"{path}/prepare")
        self.parts.withColumn("features", F.lit(json.dumps(self.features))).write.mode("overwrite").parquet(f"{path}/forest")


def load(spark: SparkSession, path: str) -> ForestModel:
    parts = spark.read.parquet(f"{path}/forest")
    features = json.loads(parts.first()["features"])
    return ForestModel(PipelineModel.load(f"{path}/prepare"), features, parts.drop("features"))


def binned_name(feature: str) -> str:
    return f"{feature}__bin"


def unpacked(row) -> tuple[int, list[tuple]]:
    arrays = [np.array(row[k]) for k in ("feature", "bin", "child", "value")]
    return row["trees"], [tuple(a[i:j] for a in arrays) for i, j in zip([0, *row["ends"]], row["ends"])]


def walk(levels: list[tuple], trees: int, bins: np.ndarray) -> np.ndarray:
    """Sum over the trees of the probability of class 1 of each binned row."""
    value = np.zeros(trees * len(bins))
    node, row, slot = np.repeat(np.arange(trees), len(bins)), np.tile(np.arange(len(bins)), trees), np.arange(len(value))
    for feature, cut, child, leaf in levels:
        ends = child[node] < 0
        value[slot[ends]] = leaf[node[ends]]
        node, row, slot = node[~ends], row[~ends], slot[~ends]
        node = 2 * child[node] + (bins[row, feature[node]] > cut[node])
    return value.reshape(trees, len(bins)).sum(0)


def pruned(levels: list[tuple]) -> list[tuple]:
    """As Spark's trees: two leaves of one parent that predict the same class become one."""
    out = [(feature, cut, child.copy(), value) for feature, cut, child, value in levels]
    for (_, _, child, _), (_, _, below, value) in zip(out[-2::-1], out[:0:-1]):
        at = np.flatnonzero(child >= 0)
        left, right = 2 * child[at], 2 * child[at] + 1
        child[at[(below[left] < 0) & (below[right] < 0) & ((value[left] > 0.5) == (value[right] > 0.5))]] = -1
    return out


def cut_points(filled: DataFrame, columns: list[str]) -> list[list[float]]:
    """Of each column between all values if they are few, else at its quantiles, over all rows."""
    shares = [i / grid.BINS for i in range(1, grid.BINS)]
    row = filled.agg(*[a for i, c in enumerate(columns) for a in (
        F.approx_count_distinct(col(c)).alias(f"n{i}"), F.percentile_approx(col(c), shares, 10_000).alias(f"q{i}"))]).first()
    out = []
    for i, c in enumerate(columns):
        values = np.array([])
        if row[f"n{i}"] <= 2 * grid.BINS:
            values = np.unique([r[0] for r in filled.select(col(c)).distinct().limit(grid.BINS + 1).collect()])
        few = 0 < len(values) <= grid.BINS
        points = (values[1:] + values[:-1]) / 2 if few else np.unique(row[f"q{i}"] or [])
        out.append([float(p) for p in points if np.isfinite(p)] or [0.0])
    return out


def tried(params: dict, features: int) -> int | None:
    """Features tried at a node, by the search's name or by Spark's."""
    if "featureSubset" in params:
        return grid.subset_size(params["featureSubset"], features)
    spark_sizes = {"auto": features ** 0.5, "sqrt": features ** 0.5, "log2": np.log2(features), "onethird": features / 3, "all": features}
    kind = params.get("featureSubsetStrategy", "auto")
    return max(1, int(np.ceil(spark_sizes[kind]))) if kind in spark_sizes else None


def prepared(rows: DataFrame, features: list[str], strategy: str) -> PipelineModel:
    """Fills and bins of the rows."""
    filled = [f"{f}__filled" for f in features]
    imputer = Imputer(strategy=strategy, inputCols=features, outputCols=filled).fit(rows)
    cuts = cut_points(imputer.transform(rows), filled)
    bucketizer = Bucketizer(splitsArray=[[-np.inf, *c, np.inf] for c in cuts], inputCols=filled,
                            outputCols=[binned_name(f) for f in features])
    return Pipeline(stages=[imputer, bucketizer]).fit(rows)


def counted(rows: DataFrame, prepare: PipelineModel, features: list[str], weight: str | None, limit: int) -> pd.DataFrame | None:
    """b0.. (bins), y, w, n of equal binned rows; None where they are more than ``limit``."""
    names = [f"b{i}" for i in range(len(features))]
    entries = settle(prepare.transform(rows).groupBy(
        *[col(binned_name(f)).cast("int").alias(n) for f, n in zip(features, names)],
        (F.col("label") > 0).cast("int").alias("y"), (col(weight) if weight else F.lit(1.0)).alias("w")).agg(
        F.count("*").alias("n")), "entries")
    return None if entries.count() > limit else entries.toPandas().sort_values([*names, "y", "w"], kind="stable")


def fold_of(own: pd.DataFrame, features: list[str], held: pd.DataFrame | None = None) -> grid.Fold:
    """Entries of training and of held-out rows for ``grid.grow``."""
    names, none = [f"b{i}" for i in range(len(features))], np.zeros(0)
    bins, pos, neg = np.zeros((0, len(names)), np.uint8), none, none
    if held is not None:
        both = held.assign(pos=held["n"] * held["y"], neg=held["n"] * (1 - held["y"])).groupby(names, as_index=False)[["pos", "neg"]].sum()
        bins, pos, neg = both[names].to_numpy(np.uint8), both["pos"].to_numpy(float), both["neg"].to_numpy(float)
    return grid.Fold(none, none, none, none, none, own[names].to_numpy(np.uint8), own["y"].to_numpy(np.int8),
                     own["w"].to_numpy(float), own["n"].to_numpy(np.int64), bins, pos, neg)


def fit(rows: DataFrame, family: str, params: dict, features: list[str], seed: int, strategy: str = "mean",
        weight: str | None = None, limit: int = ENTRY_LIMIT, prune: bool = True) -> ForestModel | None:
    """The forest of all rows (label, features, weight), or None where the binned rows make more than ``limit`` entries."""
    size = tried(params, len(features))
    if size is None:
        return None
    spark = rows.sparkSession
    prepare = prepared(rows, features, strategy)
    own = counted(rows, prepare, features, weight, limit)
    if own is None:
        return None
    fold = fold_of(own, features)
    shared = spark.sparkContext.broadcast(fold)
    params = params | {"featureSubset": size}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for u in pdf.itertuples():
                levels: list[tuple] = []
                grid.grow(shared.value, family, params, u.first, u.last, [params["maxDepth"]], seed, levels)
                levels = pruned(levels) if prune else levels
                flat = [np.concatenate([level[k] for level in levels]) for k in range(4)]
                yield pd.DataFrame([[u.first, u.last - u.first, np.cumsum([len(level[0]) for level in levels]), *flat]],
                                   columns=["first", "trees", "ends", "feature", "bin", "child", "value"])

    trees = params["numTrees"]
    step = min(max(grid.ENTRIES // max(1, len(own)), 4), max(1, -(-trees // spark.sparkContext.defaultParallelism)))
    ranges = [(a, min(a + step, trees)) for a in range(0, trees, step)]
    units = spark.createDataFrame(ranges, "first int, last int").repartition(len(ranges), "first")
    return ForestModel(prepare, features, settle(units.mapInPandas(run, PART), "forest"))

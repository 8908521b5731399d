"""Registered queries run the whole job: all draws, folds, trees and clusterings, and scores that were measured."""

import pytest
from pyspark.sql import functions as F

from cellweft.operators import outliers, search
from cellweft.queries import QUERIES, clusters, models

from conftest import SF


@pytest.fixture
def searches(monkeypatch):
    """What a query asks the grid for, and how many scores it gets back."""
    made = {}
    right = search.grid.grid_scores

    def note(spark, rows, drawn, *rest):
        scores = right(spark, rows, drawn, *rest)
        for family, draws in drawn.items():
            made[family] = (len(draws), {len(scores[family, d]) for d in range(len(draws))}, len(rows.y))
        return scores

    monkeypatch.setattr(search.grid, "grid_scores", note)
    return made


def test_supervised_search(spark, searches):
    rows = QUERIES["ml_05_supervised_search"](spark, SF).collect()
    assert {f: (d, n) for f, (d, n, _) in searches.items()} == {f: (100, {5}) for f in search.FAMILIES}
    assert {r["model"] for r in rows} == set(search.FAMILIES) and all(r["error"] is None for r in rows)
    # One feature says it all, so every family finds it.
    assert all(r["search_score"] == r["f1"] == 1.0 for r in rows)


def test_weighted_search(spark, searches):
    rows = QUERIES["ml_06_weighted_search"](spark, SF).collect()
    assert {f: (d, n) for f, (d, n, _) in searches.items()} == {
        f: (15 if f == "LinearSVC" else 30, {3}) for f in search.RECOVERY_FAMILIES}
    assert {r["model"] for r in rows} == set(search.RECOVERY_FAMILIES) and all(r["error"] is None for r in rows)


def test_forests():
    assert models.FOREST["numTrees"] == 100 and models.FOREST["maxDepth"] == 30


@pytest.mark.parametrize("name", ["ml_16_cluster_search", "srt_04_cluster_order"])
def test_cluster_grid(spark, name):
    got = {(r["method"], r["k"]) for r in QUERIES[name](spark, SF).collect()}
    assert got == {("KMeans", k) for k in range(2, 7)} | {("GMM", k) for k in range(2, 6)}


def test_outliers(spark):
    flagged = outliers.outliers(clusters.scaled(spark, SF), clusters.BASIC).collect()
    out = {r["row_key"] for r in flagged if r["is_outlier"]}
    assert {r["row_key"] for r in QUERIES["flt_05_inliers"](spark, SF).collect()} == {r["row_key"] for r in flagged} - out
    assert {r["row_key"] for r in QUERIES["rep_08_outlier_plane"](spark, SF).collect() if r["is_outlier"]} == out
    assert any(r["lof_outlier"] and not r["iso_outlier"] for r in flagged)


def test_registry_score(spark, monkeypatch):
    right = models.labelled
    flip = F.when(F.substring("row_key", 1, 1) < "4", 1 - F.col("label")).otherwise(F.col("label"))
    monkeypatch.setattr(models, "labelled", lambda *a: right(*a).withColumn("label", flip))
    assert 0 < QUERIES["snk_05_model_registry"](spark, SF).first()["f1"] < 1


def test_cluster_search_leaves_the_rows_to_the_fits(spark, monkeypatch):
    """A fit over a cached table decodes every row in every round; over an uncached one it keeps the vectors."""
    from pyspark.ml.clustering import GaussianMixture, KMeans

    from cellweft.operators import clustering

    levels = []
    for maker in (KMeans, GaussianMixture):
        fit = maker.fit
        monkeypatch.setattr(maker, "fit", lambda self, data, fit=fit: (levels.append(data.storageLevel), fit(self, data))[1])
    rows = spark.range(300).selectExpr("id % 3 as label", "(id % 3) * 10 + rand(1) as a", "rand(2) as b")
    found = clustering.search(rows, ["a", "b"], "label", kmeans=(2, 3), mixtures=(2,)).collect()
    assert len(found) == 3 and len(levels) == 3 and not any(level.useMemory for level in levels)
    assert found[0]["k"] == 3 and found[0]["ARI"] == 1


def test_boxes_make_only_the_boxes(spark, monkeypatch):
    """Box-Cox boxes: the report's samples and densities are no part of them; passes read the values once derived."""
    from cellweft.operators import reports
    from cellweft.queries import QUERIES
    from cellweft.queries.reports import _named
    whole = reports.boxcox_report(_named(spark, "/root/testdata/sf0.001"), "Image", "NA2")
    assert list(whole) == ["record", "means", "before", "after", "pairs", "density_before", "density_after"]
    want = [tuple(r) for stage in ("before", "after") for r in whole[stage].collect()]

    def other(*_, **__):
        raise AssertionError("not a box")

    monkeypatch.setattr(reports, "value_pairs", other)
    monkeypatch.setattr(reports, "density", other)
    got = QUERIES["rep_03_boxcox_boxes"](spark, "/root/testdata/sf0.001")
    assert sorted(tuple(r)[:-1] for r in got.collect()) == sorted(want)


def test_search_sees_every_row(spark):
    """More rows than the search once looked at: each is counted, with its fold."""
    from cellweft.operators import grid
    n = 120_000
    df = spark.range(n).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("double").alias("label"),
                               (F.col("id") % 10 == 0).alias("fold_0"))
    rows = grid.whole_rows(df, ["fold_0"], ["a"], None)
    fold = grid.make_fold(rows, 0, "mean")
    assert rows.n.sum() == n and fold.count.sum() == n * 9 // 10 and (fold.pos + fold.neg).sum() == n // 10
    assert grid.whole_rows(df, ["fold_0"], ["a"], None, 10) is None


def test_counts_make_the_same_folds():
    """An entry with a count is as many rows: fills, scales, bins and fits."""
    import numpy as np
    from cellweft.operators import grid
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(60, 2)), 2)
    x[rng.random(x.shape) < 0.1] = np.nan
    y, n, held = (rng.random(60) < 0.4).astype(np.int8), rng.integers(1, 9, 60), (np.arange(60) % 3 == 0)[:, None]
    few = grid.Rows(x, y, np.ones(60), held, n)
    many = grid.Rows(*[np.repeat(a, n, axis=0) for a in (x, y, np.ones(60), held)])
    for strategy in ("mean", "median"):
        one, two = (grid.make_fold(r, 0, strategy) for r in (few, many))
        assert np.array_equal(one.bins, two.bins) and np.array_equal(one.count, two.count) and np.array_equal(one.pos, two.pos)
        assert np.allclose(np.repeat(one.x, one.n, axis=0), two.x)
        p = {"C": 1.0, "tol": 1e-9, "maxIter": 100, "elasticNetParam": 0.3}
        assert np.allclose(np.repeat(grid.linear(one, "LogisticRegression", p), one.held_n), grid.linear(two, "LogisticRegression", p))


def test_tables_score_as_entries_do(spark):
    """Where the entries are too many to hold, all rows are fitted from tables, with the same scores."""
    from cellweft.operators import grid, search
    rows = spark.range(900).select(((F.col("id") * 7919) % 100).cast("double").alias("a"), (F.col("id") % 10).cast("double").alias("b"),
                                   (((F.col("id") * 7919) % 100 + 3 * (F.col("id") % 10)) > 70).cast("double").alias("label"),
                                   (F.col("id") % 3 == 0).alias("fold_0"), (F.col("id") % 3 == 1).alias("fold_1"))
    tree = {"impurity": "gini", "numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 2, "featureSubset": "sqrt", "classWeight": None}
    line = {"classWeight": None, "maxIter": 200, "C": 1.0, "elasticNetParam": 0.0, "tol": 1e-8}
    drawn, names = {"ForestNoBootstrap": [tree], "LogisticRegression": [line]}, ["fold_0", "fold_1"]
    held = grid.grid_scores(spark, grid.whole_rows(rows, names, ["a", "b"], None), drawn, "f1", "mean", 5)
    table = search._table_scores(rows, names, drawn, ["a", "b"], "f1", "mean", None, 5, 2)
    assert set(held) == set(table)
    for key, own in held.items():
        assert len(table[key]) == 2 and max(abs(a - b) for a, b in zip(own, table[key])) < 0.03

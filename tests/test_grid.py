"""Searches whose fits share their work, against fits made one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweft.operators import grid, sampling, search


def made(n=900, features=4, folds=3, seed=0, positives=0.5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 2)
    cut = np.quantile(x[:, 0] + 0.5 * x[:, 1] + 0.8 * rng.normal(size=n), 1 - positives) if positives != 0.5 else 0
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.8 * rng.normal(size=n)) > cut).astype(np.int8)
    x[rng.random(x.shape) < 0.02] = np.nan
    return grid.Rows(x, y, np.where(y > 0, 2.0, 1.0), np.stack([np.arange(n) % folds == i for i in range(folds)], 1))


def tree_by_tree(fold, family, params, seed):
    """One draw on one fold: every tree grown alone, to that draw's depth only."""
    total = sum(grid.grow(fold, family, params, t, t + 1, [params["maxDepth"]], seed)[0] for t in range(params["numTrees"]))
    return total / params["numTrees"]


@pytest.mark.parametrize("scoring", ["f1", "pr_auc"])
def test_same_winner_as_one_by_one(spark, scoring):
    rows, drawn = made(), {}
    for family, n in (("RandomForest", 6), ("ForestNoBootstrap", 4), ("LogisticRegression", 8), ("LinearSVC", 3)):
        rng = random.Random(family)
        drawn[family] = [search.draw(family, rng, True) for _ in range(n)]
        for p in drawn[family]:
            if "numTrees" in p:
                p["numTrees"] = p["numTrees"] // 15
    # Draws that share their trees: only depth and number differ.
    drawn["RandomForest"] += [drawn["RandomForest"][0] | {"maxDepth": d, "numTrees": n} for d, n in ((2, 7), (5, 30), (30, 12))]
    got = grid.grid_scores(spark, rows, drawn, scoring, "median", 7)
    for family, draws in drawn.items():
        for d, p in enumerate(draws):
            assert len(got[family, d]) == 3
            for i in range(3):
                fold = grid.make_fold(rows, i, "median")
                y = fold.held_y.astype(float)
                if family in grid.FORESTS:
                    score, cut, pos, neg = np.round(tree_by_tree(fold, family, p, 7), 12), 0.5, fold.pos, fold.neg
                else:
                    score, cut, pos, neg = grid.linear(fold, family, p), 0.0, y, 1 - y
                want = grid.f1(score, cut, pos, neg) if scoring == "f1" else grid.average_precision(score, pos, neg)
                assert got[family, d][i] == pytest.approx(want, abs=1e-9)


def brute_tree(fold, params, seed_number, depth, rows, path=1):
    """Probability of class 1 of each held entry, by recursion on one node (no bootstrap)."""
    w = fold.count[rows] * fold.entry_weight[rows]
    out = np.full(len(fold.pos), (w * fold.entry_y[rows]).sum() / w.sum())
    y = fold.entry_y[rows]
    if depth == 0 or y.min() == y.max():
        return out
    kind, leaf, best = params["impurity"], params["minInstancesPerNode"], (1e-9, None, None)
    chosen = grid.shuffled(np.array([seed_number], np.uint64), np.array([path], np.uint64), fold.bins.shape[1])[0]
    use = np.sort(chosen.argsort()[:grid.subset_size(params["featureSubset"], fold.bins.shape[1])])
    node = lambda m: float(grid.impurity(kind, np.array((w[m] * y[m]).sum()), np.array(w[m].sum())))
    for f in use:
        for b in range(grid.BINS - 1):
            left = fold.bins[rows, f] <= b
            if fold.count[rows][left].sum() >= leaf and fold.count[rows][~left].sum() >= leaf:
                gain = node(np.ones(len(rows), bool)) - node(left) - node(~left)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, f, b)
    if best[1] is None:
        return out
    left, held = fold.bins[rows, best[1]] <= best[2], fold.held_bins[:, best[1]] <= best[2]
    low = brute_tree(fold, params, seed_number, depth - 1, rows[left], 2 * path)
    high = brute_tree(fold, params, seed_number, depth - 1, rows[~left], 2 * path + 1)
    return np.where(held, low, high)


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_tree_against_recursion(kind):
    import hashlib
    rows = made(300, 3)
    fold = grid.make_fold(rows, 0, "mean")
    params = {"impurity": kind, "minInstancesPerNode": 4, "featureSubset": "log2"}
    for t in range(3):
        number = int.from_bytes(hashlib.md5(f"5-ForestNoBootstrap-{t}".encode()).digest()[:8], "little")
        for depth in (1, 3, 12):
            want = brute_tree(fold, params, number, depth, np.arange(len(fold.count)))
            assert np.allclose(grid.grow(fold, "ForestNoBootstrap", params, t, t + 1, [depth], 5)[0], want)


def test_class_weights_change_the_fit():
    rows = made(2000, positives=0.05)
    rows.weight[:] = 1
    fold = grid.make_fold(rows, 0, "mean")
    y = fold.held_y.astype(float)

    def caught(family, weight):
        p = {"impurity": "gini", "minInstancesPerNode": 9, "featureSubset": "sqrt", "C": 1.0, "tol": 1e-6, "maxIter": 100,
             "classWeight": weight}
        if family in grid.FORESTS:
            s = grid.grow(fold, family, p, 0, 40, [6], 1)[0]
            return fold.pos[s > 20].sum() / fold.pos.sum()
        return y[grid.linear(fold, family, p) > 0].sum() / y.sum()

    for family, kinds in (("RandomForest", ("balanced", "balanced_subsample")), ("LogisticRegression", ("balanced",)), ("LinearSVC", ("balanced",))):
        for kind in kinds:
            assert caught(family, kind) > caught(family, None) + 0.2
    subsample = [grid.grow(fold, "RandomForest", {"impurity": "gini", "minInstancesPerNode": 9, "featureSubset": "sqrt",
                                                  "classWeight": k}, 0, 10, [6], 1)[0] for k in ("balanced", "balanced_subsample")]
    assert not np.allclose(*subsample)


@pytest.mark.parametrize("mix", [0.0, 0.4, 1.0])
def test_logistic_optimum(mix):
    rows = made(500)
    fold = grid.make_fold(rows, 0, "mean")
    lam = 0.03
    b = grid.newton(fold.x, fold.y, fold.weight, lam * mix, lam * (1 - mix), grid.logistic_loss, 1e-14, 200)
    p = 1 / (1 + np.exp(-(fold.x @ b[:-1] + b[-1])))
    share = fold.weight / fold.weight.sum()
    slope = np.append(fold.x, np.ones((len(p), 1)), 1).T @ (share * (p - fold.y))
    slope[:-1] += lam * (1 - mix) * b[:-1]
    assert abs(slope[-1]) < 1e-6
    for g, v in zip(slope[:-1], b[:-1]):
        assert abs(g + lam * mix * np.sign(v)) < 1e-5 if v else abs(g) <= lam * mix + 1e-6


def test_hinge_near_its_optimum():
    rows = made(400)
    fold = grid.make_fold(rows, 0, "mean")
    sign, share = np.where(fold.y > 0, 1, -1), fold.weight / fold.weight.sum()
    value = lambda b: share @ np.maximum(0, 1 - sign * (fold.x @ b[:-1] + b[-1])) + 0.005 * b[:-1] @ b[:-1]
    b = None
    for width in (2.0, 0.5, 0.1, 0.03):
        b = grid.newton(fold.x, fold.y, fold.weight, 0.0, 0.01, grid.hinge_loss, 1e-6, 100, width, b)
    rng = np.random.default_rng(1)
    assert value(b) < min(value(b + rng.normal(scale=s, size=len(b))) for s in (0.02, 0.1, 0.5) for _ in range(200)) + 0.02


def test_scores():
    rng = np.random.default_rng(2)
    score = rng.integers(0, 20, 200) / 20
    y = (rng.random(200) < score).astype(float)
    assert grid.f1(score, 0.5, y, 1 - y) == pytest.approx(
        2 * y[score > 0.5].sum() / (y[score > 0.5].size + y.sum()))
    want = seen = 0.0
    for s in sorted(set(score), reverse=True):
        up = score >= s
        want += (y[up].sum() - seen) / y.sum() * y[up].mean()
        seen = y[up].sum()
    assert grid.average_precision(score, y, 1 - y) == pytest.approx(want)
    assert grid.average_precision(score, 0 * y, y + 1) == 0.0


def labelled(spark, n=3000):
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("row_key"), (F.col("id") % 7 == 0).cast("double").alias("label"),
                                 ((F.col("id") * 7919) % 1000 / 1000 + F.when(F.col("id") % 7 == 0, 0.6).otherwise(0)).alias("a"),
                                 F.when(F.col("id") % 11 > 0, (F.col("id") * 104729) % 100).alias("b"))


def test_search_families(spark):
    rows = sampling.row_folds(labelled(spark), "label", 3)
    rows = rows.withColumns({f"fold_{i}": F.col("fold") == i for i in range(3)})
    fitted = search.search_families(rows, ["fold_0", "fold_1", "fold_2"], {"ForestNoBootstrap": 2, "LogisticRegression": 4, "LinearSVC": 2},
                                    ["a", "b"], 3, "pr_auc", "median", None, True, rows=1000)
    assert [f.family for f in fitted] == ["ForestNoBootstrap", "LogisticRegression", "LinearSVC"]
    for f in fitted:
        assert f.error is None and f.search_score > 0.5
    for f in search.evaluate(fitted, rows):
        # The threshold follows the drawn class weights, the ranking must be good whatever they are.
        assert f.scores["roc_auc"] > 0.8
    none = search.search_families(rows.where("label = 0"), ["fold_0"], {"LogisticRegression": 1}, ["a"], 3)
    assert none[0].error


def test_bounded_rows(spark):
    rows = labelled(spark).withColumn("fold_0", F.col("a") > 0.5)
    own = grid.take_rows(rows, ["fold_0"], ["a", "b"], None, 500)
    assert own.x.shape == (500, 2) and np.isnan(own.x[:, 1]).any() and own.held.shape == (500, 1)
    assert (own.x == grid.take_rows(rows.repartition(5), ["fold_0"], ["a", "b"], None, 500).x)[:, 0].all()


def test_units_cover_all_draws_once():
    rng = random.Random(1)
    drawn = {"RandomForest": [search.draw("RandomForest", rng) for _ in range(40)]}
    seen = {}
    import json
    for family, fold, _, a, b, wanted in grid.units(drawn, 2, 64):
        for d, depth, n in json.loads(wanted):
            assert drawn[family][d]["maxDepth"] == depth and drawn[family][d]["numTrees"] == n
            seen.setdefault((d, fold), []).append((a, b))
    for (d, _), ranges in seen.items():
        ranges.sort()
        assert ranges[0][0] == 0 and ranges[-1][1] == drawn["RandomForest"][d]["numTrees"]
        assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
    assert len(seen) == 80


@pytest.mark.parametrize("folds", [2, 3, 5])
def test_row_folds_are_stratified(spark, folds):
    rows = sampling.row_folds(labelled(spark, 5000).withColumn("label", F.when(F.col("label") == 1, None).otherwise(F.col("label"))), "label", folds)
    counts = {}
    for r in rows.groupBy("label", "fold").count().collect():
        counts.setdefault(r["label"], []).append(r["count"])
    assert all(len(c) == folds and max(c) - min(c) <= 1 for c in counts.values()) and len(counts) == 2


def test_small_buckets_give_the_same_folds(spark, monkeypatch):
    one = {r["row_key"]: r["fold"] for r in sampling.row_folds(labelled(spark), "label").collect()}
    monkeypatch.setattr(sampling, "FOLD_ROWS", 16)
    assert one == {r["row_key"]: r["fold"] for r in sampling.row_folds(labelled(spark), "label").collect()}


def test_group_folds_even_out_classes(spark):
    rows = [(f"f{g}", int(i < p)) for g, (n, p) in enumerate([(100, 90), (100, 10), (60, 6), (60, 54), (30, 15), (10, 1), (10, 9)])
            for i in range(n)] + [(None, 1)] * 4
    df = sampling.group_folds(spark.createDataFrame(rows, "source_file string, label int"), "label", folds=2)
    assert df.count() == len(rows) and df.groupBy("source_file").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    share = df.groupBy("fold").agg(F.avg("label").alias("m"), F.count("*").alias("n")).collect()
    assert len(share) == 2 and abs(share[0]["m"] - share[1]["m"]) < 0.15 and abs(share[0]["n"] - share[1]["n"]) < 60

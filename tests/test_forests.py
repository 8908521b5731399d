"""Fits from counts of equal rows, against fits of every row."""

import random

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cellweft.operators import forests, grid, search
from cellweft.operators.scaling import numeric_stages

FOREST = {"numTrees": 30, "maxDepth": 8, "impurity": "gini", "minInstancesPerNode": 3, "featureSubset": "all", "classWeight": None}


def rows(spark, n=4000, copies=1):
    rng = random.Random(5)
    own = []
    for i in range(n):
        a, b = rng.randint(0, 20), rng.randint(0, 5)
        own.append((f"r{i}", None if i % 50 == 0 else float(a), float(b), float(a + b + rng.gauss(0, 4) > 12)))
    table = spark.createDataFrame(own, "row_key string, a double, b double, label double")
    return table.crossJoin(spark.range(copies).withColumnRenamed("id", "copy")).withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(1.0))


def test_more_rows_make_no_more_work(spark, monkeypatch):
    # The forest sees entries; their number stays when every row comes 20 times, and no row goes to Spark's forest.
    monkeypatch.setattr(search, "classifier", None)
    sizes = []
    real = grid.grow
    monkeypatch.setattr(forests, "settle", lambda df, name="t": (sizes.append(df.count()) if name == "entries" else None, df.cache())[1])
    for copies in (1, 20):
        model = search._fit(rows(spark, copies=copies), "RandomForest", FOREST, ["a", "b"], 1, "mean", "w")
        assert isinstance(model, forests.ForestModel)
    assert sizes[0] == sizes[1] <= 22 * 6 * 2 and real is grid.grow


def test_trees_are_those_of_the_search(spark):
    data = rows(spark)
    model = forests.fit(data, "ForestNoBootstrap", FOREST, ["a", "b"], 7, "mean", "w", prune=False)
    pdf = data.toPandas().sort_values("row_key", kind="stable")
    n = len(pdf)
    held = np.zeros((2 * n, 1), bool)
    held[n:] = True
    x = np.vstack([pdf[["a", "b"]].to_numpy(float)] * 2)
    both = grid.Rows(x, np.tile(pdf["label"].to_numpy().astype(np.int8), 2), np.tile(pdf["w"].to_numpy(), 2), held)
    fold = grid.make_fold(both, 0, "mean")
    want = grid.grow(fold, "ForestNoBootstrap", FOREST, 0, 30, [8], 7)[0] / 30
    got = search.transform(model, data.dropDuplicates(["a", "b"])).toPandas()
    assert {round(v, 9) for v in got["probability"]} == {round(v, 9) for v in want}
    assert (got["prediction"] == (got["probability"] > 0.5)).all()


def test_close_to_sparks_forest(spark):
    data = rows(spark, copies=3)
    own = search.transform(forests.fit(data, "RandomForest", FOREST, ["a", "b"], 7, "mean", "w"), data).toPandas()
    params = {k: v for k, v in FOREST.items()}
    stages = numeric_stages(["a", "b"]) + [search.classifier("RandomForest", params, 7, "w", 1.0, 2)]
    theirs = search.transform(Pipeline(stages=stages).fit(data), data).toPandas()
    both = own.merge(theirs, on=["row_key", "copy"])
    assert (both["probability_x"] - both["probability_y"]).abs().mean() < 0.02
    assert (both["prediction_x"] == both["prediction_y"]).mean() > 0.98


def test_kept_and_read(spark, tmp_path):
    data = rows(spark, 500)
    fitted = search.Fitted("RandomForest", FOREST, 0.0, search._fit(data, "RandomForest", FOREST, ["a", "b"], 1, "median", None))
    search.save_model(fitted, str(tmp_path))
    loaded = search.load_model(str(tmp_path), "RandomForest")
    score = lambda m: search.transform(m, data).orderBy("row_key").collect()
    assert score(loaded) == score(fitted.model)


def test_many_entries_go_to_spark(spark):
    assert forests.fit(rows(spark, 300), "RandomForest", FOREST, ["a", "b"], 1, limit=10) is None


def test_large_bootstraps_draw_as_many_rows():
    count = np.array([3_000_000, 5, 1])
    drawn = grid.bootstrap(count, 3)
    assert drawn.sum() == count.sum() and abs(int(drawn[0]) - 3_000_000) < 100


def test_linear_fits_of_merged_rows(spark):
    data = rows(spark, 1500, 3)
    # The hinge has corners, near which Spark's steps end in slightly different places.
    for family, params, near in (("LogisticRegression", {"regParam": 1e-3, "elasticNetParam": 0.3, "maxIter": 200, "tol": 1e-10}, 1e-3),
                           ("LinearSVC", {"regParam": 1e-2, "maxIter": 200, "tol": 1e-8}, 0.1)):
        model = search._fit(data, family, params, ["a", "b"], 1, "mean", "w")
        model = model[0] if isinstance(model, tuple) else model
        stages = numeric_stages(["a", "b"]) + [search.classifier(family, params, 1, "w")]
        want = Pipeline(stages=stages).fit(data).stages[-1]
        assert np.allclose(model.stages[-1].coefficients.toArray(), want.coefficients.toArray(), atol=near)


def test_linear_fits_of_the_search_merge_rows(monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, (3000, 2)).astype(float)
    y = (x.sum(1) + rng.normal(size=3000) > 4).astype(np.int8)
    fold = grid.make_fold(grid.Rows(x, y, np.ones(3000), (np.arange(3000) % 3 == 0)[:, None]), 0, "mean")
    sizes, real = [], grid.newton
    monkeypatch.setattr(grid, "newton", lambda x, *a: (sizes.append(len(x)), real(x, *a))[1])
    p = {"C": 1.0, "elasticNetParam": 0.5, "tol": 1e-12, "maxIter": 100, "classWeight": "balanced"}
    got = grid.linear(fold, "LogisticRegression", p)
    assert max(sizes) <= 50
    w = grid.class_factors(fold.y, np.ones(len(fold.y)), "balanced")[fold.y]
    b = real(fold.x, fold.y, w, 0.5 / w.sum(), 0.5 / w.sum(), grid.logistic_loss, 1e-12, 100)
    assert np.allclose(got, fold.held_x @ b[:-1] + b[-1], atol=1e-6)
